"""Near-duplicate detection with SimHash fingerprints in a hierarchical Gray-order index.

A node of the index is a masked bit pattern that all fingerprints below it share. The
nodes at the top are spread over the cluster: by the pigeonhole rule, two fingerprints
that differ in at most r bits agree on one of r + 1 segments, so each fingerprint
goes below the r + 1 nodes (segment mask, its bits there). A node with more
fingerprints than a task should hold gets child nodes in the same way, by segments of
the bits that its mask leaves. Below, inside a task, fingerprints are sorted by Gray
rank, runs of neighbours are factored into nodes, level on level, and a search carries
the differences counted so far down the tree, leaving a whole group once they
exceed r.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, load, text_or_empty
from roadpulse.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DIFFERENCES = 2
HASH_SEED = 42
# Most fingerprints below a node that one task searches.
LEAF_ROWS = 2048
# Members and pairs of members that a task searches, about, and the most tasks.
TASK_ROWS, TASK_PAIRS, MOST_TASKS = 8_000, 20_000_000, 50_000
# Children of a node inside a task.
_FAN = 8
# Pairs of query and node that a search holds at once.
_FRONTIER = 1 << 20
_CHUNK = 1 << 16
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a UTF-8 text; 0 if it has no word."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    take = max(len(found) - words + 1, 1)
    first, last = starts[:take].tolist(), ends[-take:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for low in range(0, take, _CHUNK):
        part = zip(first[low : low + _CHUNK], last[low : low + _CHUNK], strict=True)
        hashes = np.array([digest(joined[i:j], HASH_SEED) for i, j in part], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > take, bitorder="little").view("<u8")[0])


def _fingerprinter(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py() or b"", words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(marks.view(np.int64))], ["id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """`id`, `text_hash` and `fp` (the 64 bits as a signed long) of every row; null text counts as empty."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"))
    return slim.mapInArrow(_fingerprinter(words), "id long, text_hash long, fp long")


# ------------------------------------------------------------ index in a task


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence, in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_tree(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of nodes from the root down to the codes: residual masks and patterns.

    A node's residual mask has the bits that all codes below it share and that its
    parent doesn't already hold. `codes` must be in Gray order.
    """
    masks, values = [np.full(len(codes), _FULL)], [codes]
    while len(values[-1]) > 1:
        at = np.arange(0, len(values[-1]), _FAN)
        every, some = np.bitwise_and.reduceat(values[-1] & masks[-1], at), np.bitwise_or.reduceat(values[-1] & masks[-1], at)
        shared = np.bitwise_and.reduceat(masks[-1], at) & ~(every ^ some)
        masks.append(shared)
        values.append(every & shared)
    levels = []
    for level in range(len(masks) - 1, -1, -1):
        residual = masks[level]
        if level + 1 < len(masks):
            residual = residual & ~masks[level + 1][np.arange(len(residual)) // _FAN]
        levels.append((residual, values[level]))
    return levels


def near_pairs(codes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i < j) of all pairs of codes, in Gray order, that differ in at most `most` bits."""
    levels = gray_tree(codes)
    sizes = [len(values) for _, values in levels]
    pending = [(0, query, np.zeros(len(query), np.int64), np.zeros(len(query), np.uint8)) for query in np.array_split(np.arange(len(codes)), max(1, _FAN * len(codes) // _FRONTIER))]
    while pending:
        level, query, node, seen = pending.pop()
        residual, values = levels[level]
        seen = seen + np.bitwise_count((codes[query] ^ values[node]) & residual[node])
        # Every pair is found from its earlier place.
        span = _FAN ** (len(levels) - 1 - level)
        stay = (seen <= most) & ((node + 1) * span > query + 1)
        query, node, seen = query[stay], node[stay], seen[stay]
        if level + 1 == len(levels):
            if len(query):
                yield query, node
            continue
        children = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
        query, seen = np.repeat(query, _FAN), np.repeat(seen, _FAN)
        real = children < sizes[level + 1]
        query, children, seen = query[real], children[real], seen[real]
        for low in range(0, len(query), _FRONTIER):
            part = slice(low, low + _FRONTIER)
            pending.append((level + 1, query[part], children[part], seen[part]))


def forest(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same codes as all near pairs do, one per code at most."""
    codes = codes[np.argsort(gray_rank(codes))]
    root = np.arange(len(codes))
    for left, right in near_pairs(codes, most):
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right = left[apart], right[apart]
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(root, high, low)
            while (root != root[root]).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(codes)))
    return codes[moved], codes[root[moved]]


def spanning(left: np.ndarray, right: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Which of the pairs to keep so that they join the same places; `root` says what earlier pairs joined, and is brought up to date."""
    kept, rows = [], np.arange(len(left))
    while True:
        a, b = root[left[rows]], root[right[rows]]
        apart = a != b
        rows, low, high = rows[apart], np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        if not len(rows):
            return np.concatenate(kept) if kept else rows
        _, first = np.unique(high, return_index=True)
        root[high[first]] = low[first]
        kept.append(rows[first])
        while (root != root[root]).any():
            root[:] = root[root]


def _search(most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, sides = [], []
            for members in batch.column(0):
                codes = np.unique(members.values.field("fp").to_numpy(zero_copy_only=False)).view(np.uint64)
                a, b = forest(codes, most)
                ends.append(a.view(np.int64))
                sides.append(b.view(np.int64))
            u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (ends, sides))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


# --------------------------------------------------------- index on the cluster


def _signed(code: int) -> int:
    return code - (1 << BITS) if code >> BITS - 1 else code


def segments(mask: int, parts: int) -> list[int]:
    """Masks of `parts` near-equal runs of the bits that `mask` leaves."""
    free = [bit for bit in range(BITS - 1, -1, -1) if not mask >> bit & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def links(codes: DataFrame, most: int = MAX_DIFFERENCES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints `fp` that connect all that differ in at most `most` bits.

    Inside one node links are thinned to a spanning forest, so a dense node emits
    fewer links than it has members.
    """
    return search(codes.select("fp"), _search(most), "u long, v long", most, leaf_rows)


def search(codes: DataFrame, inside: Callable, schema: str, most: int, leaf_rows: int = LEAF_ROWS, shared: int = 0) -> DataFrame:
    """What `inside` finds in the lists of members (all columns of `codes`, `fp` among them) of the index's nodes.

    Any two fingerprints that differ in at most `most` of the bits outside the mask `shared`, and
    not at all inside it, are members of one node at least. Nodes are split until no node has more
    than `leaf_rows` members, or until too few bits are left to split; a node then has at
    most two to the power of those bits, as long as fingerprints are distinct. Nodes are dealt to
    as many tasks as the pairs of their members ask for.
    """
    spark = codes.sparkSession
    names = codes.columns
    rows = codes.withColumn("mask", F.lit(_signed(shared)).cast("long"))
    masks, found = [shared], []
    while True:
        below = {mask: [mask | part for part in segments(mask, most + 1)] for mask in masks}
        table = F.create_map(*[c for mask, nexts in below.items() for c in (F.lit(_signed(mask)), F.array(*[F.lit(_signed(m)) for m in nexts]))])
        spread = rows.select(*names, F.explode(table[F.col("mask")]).alias("mask")).withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = cut_lineage(spread.groupBy("mask", "pattern").count().filter("count > 1"))
        known = spread.join(sizes, ["mask", "pattern"])
        masks = [mask for nexts in below.values() for mask in nexts]
        splittable = BITS - masks[0].bit_count() > 2 * (most + 1)
        fits = F.col("count") <= leaf_rows if splittable else F.lit(True)
        leaves = known.filter(fits)
        load = sizes.filter(fits).agg(F.sum("count").alias("rows"), F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs")).first()
        tasks = 1 + (load["rows"] or 0) // TASK_ROWS + int((load["pairs"] or 0) // TASK_PAIRS)
        # A fixed number: the lists are small, and tasks put together by their bytes would search one after the other.
        dealt = leaves.repartition(min(tasks, MOST_TASKS), "mask", "pattern")
        held = dealt.groupBy("mask", "pattern").agg(F.collect_list(F.struct(*names)).alias("members")).select("members")
        found.append(held.mapInArrow(inside, schema))
        if not splittable or sizes.filter(F.col("count") > leaf_rows).isEmpty():
            break
        rows = cut_lineage(known.filter(F.col("count") > leaf_rows).select(*names, "mask"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    most: int = MAX_DIFFERENCES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """One row per document: `id`, `text_hash`, `fp` and `component_id`, the smallest id reachable over links.

    Equal fingerprints are one node of the graph, so copies are never paired. Texts
    without words and null texts have fingerprint zero and link like any other. Rows
    with a null id take part but give no component its id. An empty table gives none.
    """
    marked = cut_lineage(fingerprints(docs, id_col, text_col, words))
    codes = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(codes, most, leaf_rows))
    placed = codes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(smallest, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("id", "text_hash", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, whole, that stay when each group keeps the document with its smallest id.

    Rows that repeat both that id and its text stay together, as do the rows of a group
    that has no id at all.
    """
    groups = near_groups(docs, id_col, text_col, **options)
    gone = cut_lineage(groups.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct())
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__hash"))
    return docs.join(gone, same, "left_anti")


def op1_simhash_groups(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(load(spark, sf_dir, "documents", "doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


QUERIES = {"op1_simhash_groups": op1_simhash_groups}
ORACLES: dict[str, str] = {}
