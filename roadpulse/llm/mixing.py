"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every source gets the mean repetition rate that brings it to its target share. A
document's number of copies is the inverse Poisson distribution at a uniform number
hashed from the seed, its id and its text, so it doesn't change between runs, tasks
or retries. Copies are then put in one global hash order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import column, cut_lineage, load, text_or_empty, without

SEED = "mix-1"
# Hex digits of the hash that make the uniform number: 52 bits, exact in a double.
_DIGITS = 13


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, other: float = 1.0, scale: float = 1.0, source_col: str = "source") -> DataFrame:
    """Per source: `__source` and `rate`, the mean number of copies of its documents.

    A source's target share is its weight (`other` for one without) over the sum of
    the weights of all sources present; the mixture has `scale` times the rows of the
    input, on average. A null source is a source of its own with weight `other`.
    """
    sizes = cut_lineage(docs.groupBy(F.col(source_col).alias("__source")).agg(F.count(F.lit(1)).alias("__rows")))
    weight: Column = F.lit(float(other))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("__source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = sizes.withColumn("__weight", weight)
    rows = weighed.agg(F.sum("__rows")).scalar()
    total = weighed.agg(F.sum("__weight")).scalar()
    share = F.col("__weight") / F.nullif(total, F.lit(0.0))
    return weighed.select("__source", F.coalesce(F.lit(float(scale)) * rows * share / F.col("__rows"), F.lit(0.0)).alias("rate"))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """Per source: `first` and `steps`, the cumulative Poisson distribution at first, first + 1, ...

    It goes from ten standard deviations and forty terms below the mean to as many beyond it,
    past the smallest and the largest uniform number of 52 bits, so no count is cut off and the
    array has some twenty deviations of terms, whatever the rate. A first term above zero
    comes from Stirling's series for the logarithm of its probability.
    """
    reach = F.ceil(10 * F.sqrt("rate") + 40)
    first = F.floor(F.col("rate")).cast("long") - reach
    # Where the series starts it is exact to a double; lower distributions start at zero.
    first = F.when(first >= 40, first).otherwise(F.lit(0).cast("long"))
    terms = rates.withColumn("first", first).withColumn("__k", F.explode(F.sequence(F.col("first"), F.ceil(F.col("rate")) + reach)))
    along = Window.partitionBy("__source").orderBy("__k")
    k, n = F.col("__k").cast("double"), F.col("first").cast("double")
    # ln of the first term: Stirling's error, and n ln(n / rate) + rate - n without taking large numbers from each other.
    x = (F.col("rate") - n) / n
    tail = n * (x - F.log1p(x)) + 0.5 * F.ln(F.lit(2 * math.pi) * n) + 1 / (12 * n) - 1 / (360 * n * n * n) + 1 / (1260 * n * n * n * n * n)
    start = F.when(F.col("first") == 0, -F.col("rate")).otherwise(-tail)
    ratio = F.when(F.col("__k") > F.col("first"), F.ln(F.col("rate") / k)).otherwise(start)
    logs = terms.withColumn("__ln", F.sum(ratio).over(along))
    chance = F.when(F.col("rate") == 0, F.when(F.col("__k") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.exp(F.col("__ln")))
    reached = logs.withColumn("__reached", F.sum(chance).over(along))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("__k", "__reached"))), lambda step: step["__reached"])
    return reached.groupBy("__source", "rate", "first").agg(ordered.alias("steps"))


def replicate(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    other: float = 1.0,
    scale: float = 1.0,
    seed: str = SEED,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The mixture: every document as often as drawn, in global hash order.

    Keeps all columns and adds `copy` (from 0), `n_copies`, `rate` and `shuffle_key`;
    input columns with these names are replaced. Rows with equal id and text get
    equal counts. Null ids and texts hash as empty; a null source is a source of its
    own; an empty table gives an empty mixture. Any source may be as large as it
    likes: rates are a small table, and a hot source stays where its rows are.
    """
    docs = without(docs, {"copy", "n_copies", "rate", "shuffle_key"})
    names = docs.columns
    steps = cut_lineage(poisson_steps(source_rates(docs, weights, other, scale, source_col)))
    digest = F.md5(text_or_empty(text_col))
    mark = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest)
    drawn = docs.withColumn("__mark", mark).withColumn("__u", F.conv(F.substring(F.md5("__mark"), 1, _DIGITS), 16, 10).cast("double") / float(1 << 4 * _DIGITS))
    placed = drawn.join(steps, F.col(source_col).eqNullSafe(F.col("__source")))
    counted = placed.withColumn("n_copies", (F.col("first") + F.size(F.filter("steps", lambda step: step <= F.col("__u")))).cast("int"))
    copies = counted.filter("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", "__mark", F.col("copy").cast("string"))))
    mixed = keyed.select(*map(column, names), "copy", "n_copies", "rate", "shuffle_key")
    return mixed.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key", *[c for c in (id_col,) if c in names])


def op10_poisson_mix(spark, sf_dir: str) -> DataFrame:
    """All sources brought to equal shares, in as many rows as there are."""
    return replicate(load(spark, sf_dir, "documents"))


ORACLE = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, 1.0::DOUBLE * (SELECT sum(n) FROM sizes) * (1.0::DOUBLE / (SELECT count(*) FROM sizes)) / n AS rate FROM sizes
),
steps AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS reached FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), reached + p * rate / (k + 1) FROM steps WHERE k < rate + 10 * sqrt(rate) + 40
),
marked AS (SELECT *, '{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS mark FROM documents),
drawn AS (SELECT *, ('0x' || substr(md5(mark), 1, {_DIGITS}))::BIGINT / {1 << 4 * _DIGITS}::DOUBLE AS u FROM marked),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.mark, s.rate, count(*) FILTER (s.reached <= d.u) AS n_copies
  FROM (SELECT *, row_number() OVER () AS line FROM drawn) d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
  GROUP BY d.line, d.doc_id, d.text, d.lang, d.source, d.n_chars, d.mark, s.rate
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, n_copies::INTEGER AS n_copies, rate,
       md5(mark || '|' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(n_copies)) AS copy FROM counted)
"""
QUERIES = {"op10_poisson_mix": op10_poisson_mix}
ORACLES = {"op10_poisson_mix": ORACLE}
