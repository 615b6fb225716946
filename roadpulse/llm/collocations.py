"""Phrase collocations from a weighted de Bruijn graph.

Only the longest grams are counted: they are the edges between nodes one word shorter.
The count of a node is what flows out of it plus how often a piece ends there, and so on
down to pairs, so each word adds one edge, or one correction near the end of its piece.

Phrases below the least count are never needed, nor are their parts. So words that are
rarer, and then pairs that may be, cut the pieces first. Both are known by bitmaps of
fixed size over hashes; a collision only keeps a pair that could have been cut, so counts
of all phrases at or above the least count stay exact.

Unary paths (nodes that all flow of one edge enters and leaves by one edge) are compacted
by pointer doubling; the phrases inside a path occur only as part of it.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import column, cut_lineage, load, text_or_empty

LEAST = 30
LONGEST = 4
TOP = 2000
# A phrase is dropped if a longer one that holds it has this share of its count.
COVER = 80
SCALE = 2_000_000
UNKNOWN_LANG = "und"
# Bits of the two bitmaps: 8 and 16 MB at any input size.
WORD_BITS, PAIR_BITS = 26, 27
# Words numbered together in a task before they are counted and given out.
BLOCK_WORDS = 8_000_000
# Places of one part of the pair bitmap, as a power of two.
_PART_BITS = 15

_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(0x0A if i in _MARKS else i for i in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers from 1 for words, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


class _Block:
    """The words of one language in a task, numbered; 0 ends a piece."""

    def __init__(self):
        self.numbers, self.ids = _Numbers(), array("I")

    def add(self, text: str) -> None:
        number, ids = self.numbers.__getitem__, self.ids
        # Lower-casing bytes changes A-Z alone.
        for piece in text.encode().lower().translate(_TABLE).split(b"\n"):
            words = piece.split()
            if words:
                ids.extend(map(number, words))
                ids.append(0)

    def hashes(self, lang: str) -> np.ndarray:
        start = zlib.crc32(lang.encode() + b"\0")
        out = np.zeros(len(self.numbers) + 1, np.uint64)
        out[1:] = np.fromiter((zlib.crc32(word, start) for word in self.numbers), np.uint64, len(self.numbers))
        return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, _Block]]:
    """Blocks of about `size` words; a text is never split between blocks of one language."""
    held: dict[str, _Block] = {}
    words = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block = held.setdefault(lang, _Block())
            before = len(block.ids)
            block.add(text)
            words += len(block.ids) - before
            if words >= size:
                yield from held.items()
                held, words = {}, 0
    yield from held.items()


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _pair_places(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    mixed = (left * _MIX) ^ ((right + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F))
    return (mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - bits)


def _is_set(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places.astype(np.int64)
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _words_kept(ids: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The word numbers, with 0 in place of words that the bitmap doesn't hold."""
    held = _is_set(words, hashes & np.uint64(8 * len(words) - 1))
    held[0] = False
    return np.where(held[ids], ids, 0)


def word_counts(base: DataFrame) -> DataFrame:
    """Counts of all words of (lang, text), summed in the tasks first."""

    def count(batches):
        for lang, block in _blocks(batches, BLOCK_WORDS):
            counts = np.bincount(np.frombuffer(block.ids, np.uint32), minlength=len(block.numbers) + 1)[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), _strings(list(block.numbers)), pa.array(counts, pa.int64())], names=["lang", "phrase", "n"]
            )

    return base.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """The set places (column `place`) as one bitmap; Spark builds it in parts, at most 2**bits / 8 bytes reach the driver."""
    part = F.expr("bitmap_bucket_number(place + 1)")
    rows = places.groupBy(part.alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits")).toLocalIterator()
    out = np.zeros(max((1 << bits) // 8, 4096), np.uint8)
    for row in rows:
        low = (row["part"] - 1) * 4096
        out[low : low + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(out) - low]
    return out


def _pair_bitmap(base: DataFrame, words: np.ndarray, least: int) -> np.ndarray:
    """Hashes of neighbouring words that together occur at least `least` times.

    Each task gives out its counts by parts of the bitmap, as arrays; counts are cut off at
    `least`, which doesn't change what reaches it. A part is put together from all tasks'
    arrays by one task, in an array of fixed size.
    """
    held = base.sparkSession.sparkContext.broadcast(words)
    kind, size = np.uint8 if least < 256 else np.uint32, 1 << _PART_BITS

    def count(batches):
        for lang, block in _blocks(batches, BLOCK_WORDS):
            hashes = block.hashes(lang)
            ids = _words_kept(np.frombuffer(block.ids, np.uint32), hashes, held.value)
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            places, counts = np.unique(_pair_places(hashes[ids[:-1][both]], hashes[ids[1:][both]], PAIR_BITS), return_counts=True)
            counts, parts = np.minimum(counts, least).astype(kind), (places >> np.uint64(_PART_BITS)).astype(np.int32)
            offsets = (places & np.uint64(size - 1)).astype(np.uint16)
            starts = np.flatnonzero(np.diff(parts, prepend=-1))
            cuts = list(zip(starts.tolist(), np.append(starts, len(parts))[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts[starts]),
                    pa.array([offsets[i:j].tobytes() for i, j in cuts], pa.binary()),
                    pa.array([counts[i:j].tobytes() for i, j in cuts], pa.binary()),
                ],
                names=["part", "offsets", "counts"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for offsets, counts in zip(table.column("offsets").to_pylist(), table.column("counts").to_pylist(), strict=True):
            total[np.frombuffer(offsets, np.uint16)] += np.frombuffer(counts, kind)
        bits = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    parts = base.mapInArrow(count, "part int, offsets binary, counts binary").groupBy("part").applyInArrow(add, "part int, bits binary")
    out = np.zeros((1 << PAIR_BITS) // 8, np.uint8)
    for row in parts.toLocalIterator():  # as many bytes as the bitmap has
        out[row["part"] * size // 8 :][: size // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _grams(base: DataFrame, words: np.ndarray, pairs: np.ndarray, longest: int) -> DataFrame:
    """Edges (`size` = longest) and piece-end corrections (smaller sizes, two words or more) with their counts `n`."""
    context = base.sparkSession.sparkContext
    held_words, held_pairs = context.broadcast(words), context.broadcast(pairs)

    def count(batches):
        for lang, block in _blocks(batches, BLOCK_WORDS):
            hashes = block.hashes(lang)
            ids = _words_kept(np.frombuffer(block.ids, np.uint32), hashes, held_words.value).astype(np.int64)
            names = [b"", *block.numbers]
            # Whether a word goes on to the next; the last id of a block is 0.
            goes = np.zeros(len(ids), bool)
            goes[:-1] = (ids[:-1] > 0) & (ids[1:] > 0)
            at = np.flatnonzero(goes)
            goes[at] = _is_set(held_pairs.value, _pair_places(hashes[ids[at]], hashes[ids[at + 1]], PAIR_BITS))
            # start: places where a run of `size` linked words starts; code: a number for those words.
            start, code = np.flatnonzero(ids > 0), ids
            for size in range(2, longest + 1):
                start = start[goes[start + size - 2]]
                _, rank = np.unique(code[start] * (len(names) + 1) + ids[start + size - 1], return_inverse=True)
                code = np.zeros(len(ids), np.int64)
                code[start] = rank
                wanted = start if size == longest else start[~goes[start + size - 1]]
                _, first, counts = np.unique(code[wanted], return_index=True, return_counts=True)
                first = wanted[first]
                spelled = [names[i] for i in ids[first]]
                for k in range(1, size):
                    spelled = [f + b" " + names[i] for f, i in zip(spelled, ids[first + k], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first), pa.string()), pa.array([size] * len(first), pa.int32()), _strings(spelled), pa.array(counts, pa.int64())],
                    names=["lang", "size", "phrase", "n"],
                )

    rows = base.mapInArrow(count, "lang string, size int, phrase string, n long")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _some_words(low: int | Column, n: int | Column, phrase: str = "phrase") -> Column:
    """n words of a phrase from number `low`, counted from 1."""
    return F.array_join(F.slice(F.split(phrase, " "), low, n), " ")


def node_counts(grams: DataFrame, longest: int) -> DataFrame:
    """Counts of two words and more: flow out of each node plus the pieces that end there."""
    counts = grams.filter(F.col("size") == longest)
    out = counts
    for size in range(longest - 1, 1, -1):
        flow = counts.select("lang", _some_words(1, size).alias("phrase"), "n")
        ends = grams.filter(F.col("size") == size).select("lang", "phrase", "n")
        counts = flow.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        counts = counts.select("lang", F.lit(size).alias("size"), "phrase", "n")
        out = out.unionByName(counts)
    return out


def unary_paths(counts: DataFrame, longest: int) -> DataFrame:
    """`lang`, `path` (words, spaced), `n`: the edges of counts, chained through their unary nodes.

    A node is unary if one edge brings all of its occurrences and one takes them all on. No
    path is longer than the piece that it lies in, and none is a ring, since pieces end.
    """
    edges = counts.filter(F.col("size") == longest).select(
        "lang", "phrase", "n", _some_words(1, longest - 1).alias("from"), _some_words(2, longest - 1).alias("to")
    )
    nodes = counts.filter(F.col("size") == longest - 1).select("lang", F.col("phrase").alias("node"), "n")
    comes = edges.select("lang", F.col("to").alias("node"), F.col("phrase").alias("before"), "n")
    leaves = edges.select("lang", F.col("from").alias("node"), "phrase", "n")
    links = nodes.join(comes, ["lang", "node", "n"]).join(leaves, ["lang", "node", "n"]).select("lang", "phrase", "before")
    # Every edge points back along its path; each round doubles the step, until all point at its first edge.
    at = edges.join(links, ["lang", "phrase"], "left").select(
        "lang",
        "phrase",
        "n",
        F.coalesce("before", "phrase").alias("head"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps"),
    )
    at = cut_lineage(at)
    while True:
        back = at.select("lang", F.col("phrase").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more"))
        new = at.join(back, ["lang", "head"]).select("lang", "phrase", "n", F.col("further").alias("head"), (F.col("steps") + F.col("more")).alias("steps"))
        moved = new.agg(F.sum("steps")).first()[0]
        if moved == at.agg(F.sum("steps")).first()[0]:
            break
        at = cut_lineage(new)
    tail = F.transform(F.array_sort(F.collect_list(F.struct("steps", F.substring_index("phrase", " ", -1).alias("word")))), lambda e: e["word"])
    paths = at.groupBy("lang", "head", "n").agg(tail.alias("words"))
    # The head's own last word comes first in the list and is in the head already.
    later = F.slice("words", F.lit(2), F.size("words"))
    return paths.select("lang", F.concat_ws(" ", F.col("head"), F.array_join(later, " ")).alias("path"), "n").select("lang", F.rtrim("path").alias("path"), "n")


def _parts(phrases: DataFrame, longest: int) -> DataFrame:
    """Every shorter phrase of two words or more inside (lang, size, phrase, n)."""
    sized = phrases.select("lang", "size", "phrase", "n", F.explode(F.sequence(F.lit(2), F.lit(longest - 1))).alias("part")).filter("part < size")
    placed = sized.select("lang", "phrase", "n", "part", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("low"))
    return placed.select("lang", _some_words(F.col("low"), F.col("part")).alias("phrase"), "n")


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    cover: int = COVER,
) -> DataFrame:
    """The `top` phrases of each language by the score of their weakest cut.

    Returns `lang, rank, phrase, a, l, r, n, score`. Words and phrases don't reach over the
    marks `.,;:!?` and line ends; A-Z is lower-cased. Null texts are empty, null languages
    "und"; other columns are not read, whatever they are called. Repeated rows count as often
    as they occur. Ties go to the larger count, then to the smaller phrase; equal cuts to the
    earlier one. A very long text is numbered in one task, like its row; everything after is
    per phrase. An empty table, or one without a phrase of `least` occurrences, gives no row.
    """
    if longest < 2:
        raise ValueError("a phrase has at least two words")
    lang = F.coalesce(column(lang_col).cast("string"), F.lit(UNKNOWN_LANG))
    base = df.select(lang.alias("lang"), text_or_empty(text_col).alias("text"))
    singles = cut_lineage(word_counts(base))
    place = F.crc32(F.concat(F.encode("lang", "UTF-8"), F.lit(bytearray(1)), F.encode("phrase", "UTF-8")))
    words = _bitmap(singles.filter(F.col("n") >= least).select(place.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).alias("place")), WORD_BITS)
    pairs = _pair_bitmap(base, words, least)
    grams = cut_lineage(_grams(base, words, pairs, longest))
    known = singles.select("lang", F.lit(1).alias("size"), "phrase", "n")
    counts = cut_lineage(node_counts(grams, longest).unionByName(known).filter(F.col("n") >= least))

    phrases = counts.filter(F.col("size") > 1)
    if longest > 2:
        # Phrases inside a path have the path's count: they are dropped without a comparison.
        paths = unary_paths(counts, longest)
        if cover <= 100:
            words_in = F.size(F.split("path", " "))
            inner = paths.filter(words_in > longest).select("lang", "path", F.explode(F.sequence(F.lit(2), words_in - longest + 1)).alias("low"))
            inner = inner.select("lang", _some_words(F.col("low"), longest - 1, "path").alias("phrase"))
            phrases = phrases.join(inner, ["lang", "phrase"], "left_anti").select("lang", "size", "phrase", "n")
        larger = _parts(counts.filter(F.col("size") > 2), longest).groupBy("lang", "phrase").agg(F.max("n").alias("covered"))
        phrases = phrases.join(larger, ["lang", "phrase"], "left")
        covered = F.coalesce(_exact("covered") * 100 >= _exact("n") * cover, F.lit(False))
        phrases = phrases.filter(~covered).select("lang", "size", "phrase", "n")

    cuts = phrases.select("lang", "size", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", _some_words(1, F.col("k"))).withColumn("rest", _some_words(F.col("k") + 1, F.col("size") - F.col("k")))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + r)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    totals = singles.groupBy("lang").agg(F.sum("n").alias("n"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents", "text", "lang"))


_ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), spelled AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, w, len(w) AS size FROM spelled WHERE len(w) > 0
), grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM runs
  UNION ALL
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ')
  FROM (SELECT lang, w, m, unnest(range(1, size - m + 2)) AS i FROM runs, (VALUES (2), (3), (4)) AS t(m) WHERE size >= m)
), counts AS (
  SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(size)::BIGINT AS n FROM runs GROUP BY lang
), cand AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), covers AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS a
  FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i FROM cand, (VALUES (2), (3)) AS t(m) WHERE size > m)
  GROUP BY ALL
), kept AS (
  SELECT c.* FROM cand c LEFT JOIN covers d USING (lang, phrase) WHERE d.a IS NULL OR 100 * d.a::HUGEINT < 80 * c.a::HUGEINT
), cuts AS (
  SELECT k.lang, k.phrase, k.a, c AS k, l.n AS l, r.n AS r, ((2000000::HUGEINT * k.a) // (l.n + r.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS c FROM kept) k
  JOIN counts l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1 : k.c], ' ')
  JOIN counts r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.c + 1 : k.size], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, t.n AS n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""

QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {"op13_collocations": _ORACLE}
