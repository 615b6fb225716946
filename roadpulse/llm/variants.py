"""Spelling variants: words of the corpus one code point apart, over a variable-length gram index.

The gram dictionary holds the grams of two and three code points that are too frequent
among the distinct words; from each place of a word a gram grows while the dictionary holds
it, to four code points at most. A gram depends on its own code points alone, so an edit
changes just the grams that cover it. The largest number of grams over one place is the
word's bound: all but so many grams are kept by any word one edit away, in the same place
counted from the start or from the end. So the bound's number and one more of a word's
rarest grams have one in common with every near word; their lists alone are merged, and
each pair in a list is verified. Words in a list that is still too long are merged by the
word without one code point as well, so no list is cut.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import column, cut_lineage, load, text_or_empty

DROP_EVERY = 199
SHORTEST = 6
LEAST = 5
# A form is a near word at least so many times as frequent.
RATIO = 5
# A gram of two or three code points grows if more distinct words have it.
HEAVY = 500
# Words of a list that are compared with each other; longer lists go by the word without one code point.
LIST = 64
# Longest gram; with SHORTEST, every word keeps at least one gram whatever the edit.
GRAM = 4
# Distinct words counted in a task before they are given out.
HELD_WORDS = 1_000_000

# Latin-1 bytes: letters stay (A-Z lower-cased), all else ends a run.
_LETTERS = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0xC0 else 0x20 for i in range(256)
)
# How a word takes part in a list: with words of its length, or as the shorter or the longer word.
_SAME, _SHORTER, _LONGER = 0, 1, 2


def _runs(text: str) -> list[bytes]:
    """The runs of letters, one byte per code point; signs beyond Latin-1 become "?"."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _damaged(words: Counter, key: str, every: int) -> Iterator[tuple[bytes, int]]:
    """The runs of a text, those that the hash picks without one code point."""
    start = zlib.crc32(f"{key}:".encode())
    for word, n in words.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = DROP_EVERY, shortest: int = SHORTEST) -> DataFrame:
    """`word`, `n`: the runs of letters of at least `shortest` code points, summed in the tasks first."""
    base = df.select(F.coalesce(column(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("text"))

    def batch_of(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in _damaged(Counter([w for w in _runs(text) if len(w) >= shortest]), key, every):
                    if len(word) >= shortest:
                        counts[word] += n
            if len(counts) >= HELD_WORDS:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    return base.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, heavy: int = HEAVY) -> dict[str, int]:
    """Grams of two and three code points in more than `heavy` words, with the number of words.

    Words are of 90 letters and two borders, so at most 92**2 + 92**3 grams (787,000) reach
    the driver and the tasks, however many words there are.
    """

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                u = f"^{word}$"
                found.update({u[p : p + q] for q in (2, 3) for p in range(len(u) - q + 1)})
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"])

    rows = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in rows.filter(F.col("n") > heavy).toLocalIterator()}


def grams(word: str, heavy: dict[str, int]) -> list[tuple[int, int]]:
    """The variable grams of `^word$` as (start, end); one that meets the end while too frequent is left out."""
    u = f"^{word}$"
    out = []
    for p in range(len(u) - 1):
        e = p + 2
        while e - p < GRAM and e < len(u) and u[p:e] in heavy:
            e += 1
        if e - p == GRAM or u[p:e] not in heavy:
            out.append((p, e))
    return out


def affected(spans: list[tuple[int, int]], length: int) -> int:
    """The most grams that one edit of the word can change: those that cover one place after the first border."""
    depth = [0] * (length + 1)
    for p, e in spans:
        depth[p] += 1
        depth[e] -= 1
    for x in range(1, length):
        depth[x] += depth[x - 1]
    return max(depth[1:length], default=0)


def signatures(word: str, heavy: dict[str, int], shortest: int) -> Iterator[tuple[int, int]]:
    """(key, part) of the lists that the word is merged in."""
    u = f"^{word}$"
    n, length = len(word), len(word) + 2
    spans = grams(word, heavy)

    def rarity(span: tuple[int, int]) -> tuple:
        g = u[span[0] : span[1]]
        # A gram's number of words is at most that of any part; one not in the dictionary is rare.
        return max(0, min(heavy.get(g[k : k + 3], 0) for k in range(max(len(g) - 2, 1)))), g, span

    spans = sorted(spans, key=rarity)[: affected(spans, length) + 1]
    key = xxhash.xxh3_64_intdigest
    for p, e in spans:
        g = u[p:e]
        yield key(f"s{n},{p},{g}".encode()), _SAME
        for size, part in ((n, _SHORTER), (n - 1, _LONGER)):
            if size >= shortest:
                yield key(f"b{size},{p},{g}".encode()), part
                yield key(f"e{size},{length - p},{g}".encode()), part


def _lists(words: DataFrame, heavy: dict[str, int], shortest: int) -> DataFrame:
    """`key`, `part`, `word`: a row for every list that a word is in."""
    held = words.sparkSession.sparkContext.broadcast(heavy)

    def sign(batches):
        for batch in batches:
            keys, parts, names = array("Q"), array("b"), []
            for word in batch.column(0).to_pylist():
                for key, part in signatures(word, held.value, shortest):
                    keys.append(key)
                    parts.append(part)
                    names.append(word)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(keys, np.uint64).view(np.int64) if keys else np.zeros(0, np.int64)),
                    pa.array(np.frombuffer(parts, np.int8).astype(np.int32) if parts else np.zeros(0, np.int32)),
                    pa.array(names, pa.string()),
                ],
                names=["key", "part", "word"],
            )

    return words.select("word").mapInArrow(sign, "key long, part int, word string")


def _pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) that share a list and are one edit apart; the join itself verifies them."""
    a, b = lists.alias("a"), lists.alias("b")
    ordered = "(a.part = 0 AND b.part = 0 AND a.word < b.word) OR (a.part = 1 AND b.part = 2)"
    near = F.expr(f"a.key = b.key AND ({ordered}) AND levenshtein(a.word, b.word, 1) = 1")
    return a.join(b, near).select(F.col("a.word").alias("a"), F.col("b.word").alias("b"))


def near_pairs(words: DataFrame, heavy: int = HEAVY, longest_list: int = LIST, shortest: int = SHORTEST) -> DataFrame:
    """Distinct pairs (a, b) of words that differ by one inserted, deleted or replaced code point.

    Words are distinct, of at least `shortest` (six or more) letters. A list with more words
    than `longest_list` isn't compared pair by pair: its words meet in the lists of what is
    left of them without one code point, which only near words share.
    """
    lists = _lists(words, gram_dictionary(words, heavy), shortest)
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    lists = cut_lineage(lists.withColumn("size", size).filter("size > 1"))
    short = lists.filter(F.col("size") <= longest_list).select("key", "part", "word")
    long = lists.filter(F.col("size") > longest_list).select("part", "word").distinct()
    place = F.explode(F.sequence(F.lit(1), F.when(F.col("part") == _SHORTER, 1).otherwise(F.char_length("word")))).alias("at")
    rest = F.expr("CASE WHEN part = 1 THEN word ELSE concat(substring(word, 1, at - 1), substring(word, at + 1)) END")
    # Words of one length differ in one place; a longer word is spelled like the shorter without any of several.
    where = F.expr("CASE WHEN part = 0 THEN at ELSE 0 END")
    left = long.select("part", "word", place).select(F.xxhash64(where, rest).alias("key"), "part", "word").distinct()
    return _pairs(short).unionByName(_pairs(left)).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """`word`, `root` for the rows (word, form): forms followed to the last, by doubling the step.

    A form is more frequent than its word, so the chains end, after a logarithm of the largest count.
    """
    at = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = cut_lineage(new)
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        at = new.select("word", "root")


def spelling_variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    ratio: int = RATIO,
    every: int = DROP_EVERY,
    shortest: int = SHORTEST,
    heavy: int = HEAVY,
    longest_list: int = LIST,
) -> DataFrame:
    """Words of at least `shortest` letters and `least` occurrences, with their near words.

    Returns `word, form, root, n, n_near, form_n`: `form` is the near word of largest n
    (ties: the smaller word) if that is at least `ratio` times the word's, `root` the end of
    the forms. Null texts have no words; null ids count as an empty id in the hash that damages
    one run in `every`. Repeated rows count as often as they occur, other columns are not read.
    A very long text is split into words in one task, like its row; all else is per word. An
    empty table gives no row.
    """
    if shortest < SHORTEST:
        raise ValueError(f"words of fewer than {SHORTEST} letters may keep no gram")
    words = cut_lineage(word_counts(df, id_col, text_col, every, shortest).filter(F.col("n") >= least))
    pairs = cut_lineage(near_pairs(words, heavy, longest_list, shortest))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.m") >= F.col("n") * ratio
    out = joined.select(
        "word",
        F.when(is_form, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    out = cut_lineage(out)
    roots = last_forms(out.filter(F.col("form").isNotNull()))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(load(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES: dict[str, str] = {}
