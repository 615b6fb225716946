"""The training-data pipeline: five stages from `documents` to packed sequences.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; `run` writes
what a stage returns and reads it again as the next one's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import exact_dedup, mixing, near_texts, packing, quality
from roadpulse.llm.common import column, cut_lineage, load
from roadpulse.llm.vocabulary import FEW_WORDS, tokenizer_path

# Mixture: every source gets an equal share, and there are as many rows as go in.
OTHER_WEIGHT, SCALE = 1.0, 1.0
GOOD = 0.5


def _with_own_columns(docs: DataFrame, operator: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """What the operator makes of `docs`, with the columns of `docs` and their names.

    The operator sees them by number, with a dictionary from names to these, so none of its own
    columns can take the place of one of `docs`.
    """
    apart = {name: f"__column_{i}" for i, name in enumerate(docs.columns)}
    made = operator(docs.toDF(*apart.values()), apart)
    return made.select(*[column(inner).alias(name) for name, inner in apart.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    It learns from the labelled rows of all documents outside the held-out fold, whatever
    is left of them in `docs`. Null and empty texts have the model's prior; repeated rows share
    their fate; an empty table stays empty. Columns of any name are kept as they are.
    """
    everything = load(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(everything, load(spark, sf_dir, "labels"))
    return _with_own_columns(docs, lambda df, names: quality.score(df, model, names["text"]).filter(F.col("score") >= GOOD))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with identical text, the one with the largest id.

    Null and empty texts are one group. Of fully repeated rows one stays. An empty table stays
    empty. Columns of any name are kept as they are.
    """
    return _with_own_columns(docs, lambda df, names: exact_dedup.survivors(df, names["doc_id"], names["text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near texts, the one with the smallest id.

    Texts are near at a similarity of 0.8 or more between their sets of five-word shingles; groups
    are what such links connect. Texts without words are one group; rows with a null id go if
    their group has an id. An empty table stays empty. Columns of any name are kept as they are.
    """
    return _with_own_columns(docs, lambda df, names: near_texts.representatives(df, names["doc_id"], names["text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target shares, documents repeated as drawn, in one global random order.

    A null source is one of its own; null ids and texts count as empty in the draw, and repeated
    rows are drawn alike. An empty table stays empty. Columns of any name are kept as they are.
    """

    def mixed(df: DataFrame, names: dict[str, str]) -> DataFrame:
        own = {f"{part}_col": names[name] for part, name in (("source", "source"), ("id", "doc_id"), ("text", "text"))}
        return mixing.replicate(df, other=OTHER_WEIGHT, scale=SCALE, **own)

    return _with_own_columns(docs, mixed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens.

    Null and empty texts have their end token alone; repeated rows are packed each; an empty table
    gives no piece. Only id and text are read.
    """
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), words=FEW_WORDS).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A classifier that is trained here, and tokenisation, can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
