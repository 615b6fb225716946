"""Near-duplicate texts at five words and a similarity of 0.8, by wide SimHash fingerprints in the Gray index.

A text's wide fingerprint has sixteen families of 32 bits, each a SimHash of its set of
shingles under hash bits of its own. At a similarity of 0.8 two texts differ in about a
seventh of all bits, so one family rarely has them within two bits, but one of sixteen mostly
does. Every family goes through the hierarchical Gray-order index, with 128 bits beside each
code that leave out nearly all unrelated pairs; a pair that it finds is taken for a candidate
only if all 512 bits are near enough, which unrelated texts never are.

Texts with equal fingerprints are one class. Classes with the same bits in a family are
compared with the first of them, the first of each with those of neighbouring bits, and
inside a node pairs are thinned to a spanning forest: a large group never makes all pairs.
Candidates that the bits leave in doubt are compared by their shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, text_or_empty
from roadpulse.llm.components import components
from roadpulse.llm.simhash import BITS, HASH_SEED, LEAF_ROWS, gray_rank, near_pairs, search, spanning

SHINGLE_WORDS = 5
SIMILARITY = 0.8
FAMILIES, FAMILY_BITS = 16, 32
MAX_DIFFERENCES = 2
WIDE_BITS = FAMILIES * FAMILY_BITS
WIDE_BYTES = WIDE_BITS // 8
# Shares of differing bits: a pair is sure to be near up to the first, and no candidate beyond the second.
# Sets with a similarity of 0.8 differ in 0.152 of the bits, give or take 0.016; with one of 0.9 in 0.104.
SURE, DOUBT = 0.104, 0.19
# Inside the index 128 bits go along with a code; they differ in 0.152, give or take 0.032.
PROBE_DOUBT, _PROBE = 0.25, 2
_CHUNK = 1 << 14


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of the word shingles of a UTF-8 text, sorted; a text with fewer words has one of all of them, one without any none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    take = max(len(found) - words + 1, 1)
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[:take].tolist(), ends[-take:].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[i:j], HASH_SEED) for i, j in pairs), np.uint64, take))


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Another 64 bits of each hash."""
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * (lane + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> bytes:
    hashes = shingles(text, words)
    if not len(hashes):
        return bytes(WIDE_BYTES)
    ones = np.zeros(WIDE_BITS, np.int64)
    for low in range(0, len(hashes), _CHUNK):
        part = hashes[low : low + _CHUNK]
        lanes = np.stack([_mixed(part, k) for k in range(WIDE_BITS // 64)], axis=1).astype("<u8")
        ones += np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def _fingerprinter(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wides, codes, probes = [], [], []
            for text in batch.column(2):
                wide = wide_fingerprint(text.as_py(), words)
                wides.append(wide)
                families = np.frombuffer(wide, "<u4").astype(np.int64)
                codes.append(families + (np.arange(FAMILIES) << FAMILY_BITS))
                probes.append(np.frombuffer(wide, "<i8")[:_PROBE])
            flat = pa.array(np.concatenate(codes) if codes else np.empty(0, np.int64))
            cuts = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * FAMILIES)
            probe = np.array(probes, np.int64).reshape(-1, _PROBE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(wides, pa.binary()), pa.ListArray.from_arrays(cuts, flat), *[pa.array(probe[:, k].copy()) for k in range(_PROBE)]],
                names=["id", "text_hash", "wide", "codes", "p0", "p1"],
            )

    return run


def _matrix(wides: pa.Array) -> np.ndarray:
    """Wide fingerprints as rows of 64-bit words."""
    return np.frombuffer(b"".join(wides.to_pylist()), "<u8").reshape(-1, WIDE_BITS // 64)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _inside(most: int, furthest: int) -> Callable:
    """Members (fp, p0, p1) of a node: pairs within `most` bits of a family and `furthest` of the probe, as a spanning forest of codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, sides = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for members in batch.column(0):
                codes, *probe = (members.values.field(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", "p0", "p1"))
                order = np.argsort(gray_rank(codes), kind="stable")
                codes, probes = codes[order], np.stack(probe, axis=1)[order]
                root = np.arange(len(codes))
                for left, right in near_pairs(codes, most):
                    near = _apart(probes[left], probes[right]) <= furthest
                    left, right = left[near], right[near]
                    kept = spanning(left, right, root)
                    ends.append(codes[left[kept]].view(np.int64))
                    sides.append(codes[right[kept]].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ends)), pa.array(np.concatenate(sides))], ["a", "b"])

    return run


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _apart(_matrix(batch.column(2)), _matrix(batch.column(3)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["u", "v", "apart"])


def _alike(words: int, similarity: float) -> Callable:
    """Pairs (u, v, text, other) whose sets of shingles have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = shingles(a.as_py(), words), shingles(b.as_py(), words)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= similarity * (len(a) + len(b) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])

    return run


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    most: int = MAX_DIFFERENCES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """One row per document: `id`, `text_hash` and `component_id`, the smallest id reachable over links.

    Linked texts have a similarity of at least `similarity` (by the sets of their shingles; links
    of texts that differ in less than a tenth of the bits are taken for such). A few links
    near that similarity are missed. Texts without words are alike, as are equal texts. Null
    texts count as empty; rows with a null id take part but give no component its id. A very
    long text is one row of one task, read in chunks of shingles. An empty table gives none.
    Only id and text are read, so other columns may have any names.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"), text_or_empty(text_col).cast("binary").alias("text"))
    schema = "id long, text_hash long, wide binary, codes array<long>, p0 long, p1 long"
    marked = cut_lineage(slim.mapInArrow(_fingerprinter(words), schema).withColumn("cls", F.xxhash64("wide")))
    whole = F.min(F.struct("wide", "codes", "p0", "p1")).alias("w")
    classes = cut_lineage(marked.groupBy("cls").agg(F.min("id").alias("first"), F.min(F.struct("id", "text_hash")).alias("shown"), whole).select("cls", "first", "shown", "w.*"))

    # The first class of each family's code stands for the code in the index; the others are compared with it.
    coded = classes.select("cls", "p0", "p1", F.explode("codes").alias("fp"))
    leaders = cut_lineage(coded.groupBy("fp").agg(F.min(F.struct("cls", "p0", "p1")).alias("leader"), F.count(F.lit(1)).alias("n")).select("fp", "n", "leader.*"))
    same = coded.select("cls", "fp").join(leaders.filter("n > 1").select("fp", F.col("cls").alias("u")), "fp").filter("cls <> u")
    furthest = int(DOUBT * WIDE_BITS)
    shared = ((1 << BITS - FAMILY_BITS) - 1) << FAMILY_BITS
    near = cut_lineage(search(leaders.select("fp", "p0", "p1"), _inside(most, int(PROBE_DOUBT * 64 * _PROBE)), "a long, b long", most, leaf_rows, shared).distinct())
    lead = leaders.select("fp", "cls")
    near = near.join(lead.select(F.col("fp").alias("a"), F.col("cls").alias("u")), "a").join(lead.select(F.col("fp").alias("b"), F.col("cls").alias("v")), "b")
    pairs = same.select("u", F.col("cls").alias("v")).unionByName(near.select("u", "v")).filter("u <> v")
    pairs = cut_lineage(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    wide = classes.select("cls", "wide")
    both = pairs.join(wide.select(F.col("cls").alias("u"), F.col("wide").alias("a")), "u").join(wide.select(F.col("cls").alias("v"), F.col("wide").alias("b")), "v")
    told = cut_lineage(both.select("u", "v", "a", "b").mapInArrow(_distance, "u long, v long, apart long").filter(F.col("apart") <= furthest))

    # Only pairs that sure links don't join anyway are compared by their texts.
    sure = told.filter(F.col("apart") <= int(SURE * WIDE_BITS)).select("u", "v")
    joined = components(sure).select(F.col("node").alias("n"), "root")
    doubtful = told.filter(F.col("apart") > int(SURE * WIDE_BITS)).select("u", "v")
    for end in ("u", "v"):
        doubtful = doubtful.join(joined.select(F.col("n").alias(end), F.col("root").alias(f"{end}_root")), end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    doubtful = cut_lineage(doubtful.filter("u_root <> v_root").select("u", "v"))
    asked = doubtful.select(F.col("u").alias("cls")).unionByName(doubtful.select(F.col("v").alias("cls"))).distinct()
    # Written, so that its size is known before the texts are moved.
    shown = cut_lineage(classes.join(asked, "cls").select("cls", F.col("shown.id").alias("__id"), F.col("shown.text_hash").alias("__hash")))
    texts = slim.join(shown, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).select("cls", "text")
    compared = doubtful.join(texts.select(F.col("cls").alias("u"), "text"), "u").join(texts.select(F.col("cls").alias("v"), F.col("text").alias("other")), "v")
    alike = compared.select("u", "v", "text", "other").mapInArrow(_alike(words, similarity), "u long, v long")

    roots = components(sure.unionByName(alike))
    placed = classes.select("cls", "first").join(roots, F.col("cls") == F.col("node"), "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.select("id", "text_hash", "cls").join(placed.join(smallest, "root").select("cls", "component_id"), "cls").select("id", "text_hash", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, whole, that stay when each group keeps the document with its smallest id.

    Rows that repeat both that id and its text stay together, as do the rows of a group
    that has no id at all.
    """
    groups = near_groups(docs, id_col, text_col, **options)
    gone = cut_lineage(groups.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct())
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__hash"))
    return docs.join(gone, same, "left_anti")
