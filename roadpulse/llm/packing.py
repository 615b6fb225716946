"""Sequence packing by shortest-pack-first over the length histogram.

Documents are tokenised once. A document longer than a sequence gives whole sequences
of its own; the remainders are counted by length, and only that histogram (at most
one count per length) comes to the driver. Lengths are placed longest first, each
into the shortest packs that have room, by counts of equal packs. Then the shortest
packs are taken apart and their pieces, cut where needed, fill the gaps of the others.
Patterns go back to documents by rank: a document is the n-th of its length, and the
pattern table says where the n-th piece of a length lies.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, load, runs_of_rows, text_or_empty
from roadpulse.llm.vocabulary import BATCH_BYTES, ID_BYTES, encoder, tokenizer_path

SEQUENCE = 4096
END_ID = 2
# A gap smaller than this is left as padding rather than filled by one more cut.
LEAST_GAP = 4


# ------------------------------------------------------------------- patterns


class Piece(NamedTuple):
    """Equal pieces of `count` documents: ranks from `rank` among those of `length`, tokens from `cut` on."""

    length: int
    rank: int
    count: int
    cut: int
    size: int


class Slot(NamedTuple):
    """Where the pieces of `count` documents lie: in as many sequences from `sequence`, at `offset`."""

    length: int
    low: int
    high: int
    cut: int
    size: int
    sequence: int
    offset: int


class Pack:
    """`count` equal packs of pieces."""

    def __init__(self, pieces: tuple[Piece, ...], count: int):
        self.pieces, self.count = pieces, count
        self.used = sum(p.size for p in pieces)


def _split(pieces: tuple[Piece, ...], count: int) -> tuple[tuple[Piece, ...], tuple[Piece, ...]]:
    """The first `count` packs' pieces, and the others'."""
    return tuple(p._replace(count=count) for p in pieces), tuple(p._replace(rank=p.rank + count, count=p.count - count) for p in pieces)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Pack]:
    """Packs of whole pieces: longest length first, into the shortest packs with room."""
    by_used: dict[int, list[Pack]] = {}
    levels: list[int] = []  # a heap of the lengths of all open packs
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            while levels and not by_used[levels[0]]:
                heapq.heappop(levels)
            if levels and levels[0] + length <= capacity:
                pack = by_used[levels[0]].pop()
                many = min(left, pack.count)
                first, others = _split(pack.pieces, many)
                if pack.count > many:
                    by_used[pack.used].append(Pack(others, pack.count - many))
                grown = Pack((*first, Piece(length, rank, many, 0, length)), many)
            else:
                # As many pieces to a new pack as fit, when nothing else is open.
                many, grown = left, Pack((Piece(length, rank, left, 0, length),), left)
                if (fit := capacity // length) > 1 and left > 1:
                    many = -(-left // fit)
                    grown = Pack((Piece(length, rank, many, 0, length),), many)
            held = by_used.setdefault(grown.used, [])
            if not held:
                heapq.heappush(levels, grown.used)
            held.append(grown)
            left, rank = left - many, rank + many
    return [pack for packs in by_used.values() for pack in packs]


def fill_gaps(packs: list[Pack], capacity: int, least_gap: int = LEAST_GAP) -> list[Pack]:
    """Take the shortest packs apart and fill the gaps of the others with their pieces, cut where needed."""
    packs = sorted(packs, key=lambda p: -p.used)
    gap = sum((capacity - p.used) * p.count for p in packs if capacity - p.used >= least_gap)
    loose: list[Piece] = []
    freed = 0
    while packs and freed < gap:
        pack = packs.pop()
        own = capacity - pack.used if capacity - pack.used >= least_gap else 0
        many = min(pack.count, max(1, -(-(gap - freed) // (pack.used + own))))
        taken, rest = _split(pack.pieces, many)
        loose.extend(taken)
        gap -= own * many
        freed += pack.used * many
        if pack.count > many:
            packs.append(Pack(rest, pack.count - many))
    done = [p for p in packs if capacity - p.used < least_gap]
    open_packs = sorted((p for p in packs if capacity - p.used >= least_gap), key=lambda p: -p.used)
    loose.sort(key=lambda p: p.size)
    while loose:
        piece = loose.pop()
        if open_packs:
            pack = open_packs.pop()
        else:
            pack = Pack((), -(-piece.count * piece.size // capacity))
        many, size = min(piece.count, pack.count), min(piece.size, capacity - pack.used)
        first, others = _split(pack.pieces, many)
        grown = Pack((*first, piece._replace(count=many, size=size)), many)
        if pack.pieces and pack.count > many:
            open_packs.append(Pack(others, pack.count - many))
        (open_packs if capacity - grown.used >= least_gap else done).append(grown)
        if piece.count > many:
            loose.append(piece._replace(rank=piece.rank + many, count=piece.count - many))
        if piece.size > size:
            loose.append(piece._replace(count=many, cut=piece.cut + size, size=piece.size - size))
    return done + open_packs


def slots(histogram: dict[int, int], capacity: int = SEQUENCE, least_gap: int = LEAST_GAP) -> list[Slot]:
    """The pattern table for a histogram of lengths up to `capacity`.

    A step of the packing uses up either a class of equal packs, which then grows into
    another, or a length, which splits at most one class in two and opens at most one.
    So there are at most twice as many patterns as lengths, whatever the counts.
    """
    out, sequence = [], 0
    for pack in fill_gaps(shortest_pack_first(histogram, capacity), capacity, least_gap):
        offset = 0
        for p in pack.pieces:
            out.append(Slot(p.length, p.rank, p.rank + p.count, p.cut, p.size, sequence, offset))
            offset += p.size
        sequence += pack.count
    return out


# ------------------------------------------------------------------ documents


def _tokenise(vocabulary: str, end_id: int, capacity: int, words: int | None) -> Callable:
    """Ids of each document, and its place among those of this task with as long a remainder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, encode = np.array([end_id], "<u4").tobytes(), encoder(vocabulary, words).encode
        part, seen, whole = TaskContext.get().partitionId(), np.zeros(capacity, np.int64), 0
        for batch in batches:
            for rows in runs_of_rows(batch, 1, BATCH_BYTES):
                ids, counts, remainders, places, before = [], [], [], [], []
                for found in encode(rows.column(1).to_pylist()):
                    body = found + end
                    count = len(body) // ID_BYTES
                    values = np.frombuffer(body, "<u4")
                    # Two bytes each wherever the ids allow it.
                    ids.append(values.astype("<u2").tobytes() if values.max() < 1 << 16 else body)
                    counts.append(count)
                    remainders.append(count % capacity)
                    places.append(int(seen[count % capacity]))
                    before.append(whole)
                    seen[count % capacity] += 1
                    whole += count // capacity
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *[pa.array(x) for x in (ids, counts, [part] * len(ids), remainders, places, before)]],
                    ["id", "ids", "doc_tokens", "part", "remainder", "place", "whole_before"],
                )

    return run


def _cut(capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for doc, body, count, base, cut, size, sequence, offset in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.frombuffer(body, "<u2" if len(body) == 2 * count else "<u4").astype("<u4")
                cuts = [(k * capacity, capacity, base + k, 0) for k in range(count // capacity)] if not cut else []
                if size is not None:
                    cuts.append((count // capacity * capacity + cut, size, sequence, offset))
                for start, length, at, place in cuts:
                    piece = ids[start : start + length].tobytes()
                    rows.append((doc, start, length, piece, zlib.crc32(piece), count, at, place))
                if len(rows) > 1024:
                    yield _rows(rows, names, types)
                    rows = []
            if rows:
                yield _rows(rows, names, types)

    return run


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = SEQUENCE,
    least_gap: int = LEAST_GAP,
    words: int | None = None,
) -> DataFrame:
    """One row per piece: `id`, `start`, `length`, `ids` (u32), `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`.

    A sequence's pieces cover it from 0 without gaps; padding is at its end only.
    Null texts are empty and have just the end id. Rows with null or repeated ids
    are packed like any other, and a long text is cut into whole sequences. Only
    id and text are read, so other columns may have any name. An empty table gives
    no piece. `words` is how many words a task remembers at most, for memory only.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    schema = "id long, ids binary, doc_tokens long, part long, remainder long, place long, whole_before long"
    tokens = cut_lineage(slim.mapInArrow(_tokenise(vocabulary, end_id, capacity, words), schema))
    # Ranks: what earlier tasks have of a length, plus the place within the task.
    sizes = cut_lineage(tokens.groupBy("part", "remainder").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("doc_tokens") / capacity)).alias("whole")))
    histogram = {r["remainder"]: r["n"] for r in sizes.filter("remainder > 0").groupBy("remainder").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("remainder").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = sizes.groupBy("part").agg(F.sum("whole").alias("whole")).select("part", F.coalesce(F.sum("whole").over(parts), F.lit(0)).alias("base"))
    starts = sizes.select("part", "remainder", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")).join(wholes, "part")
    table = slots(histogram, capacity, least_gap)
    packed = max((s.sequence + s.high - s.low for s in table), default=0)
    pattern = spark.createDataFrame(
        table, "length long, low long, high long, cut long, size long, sequence long, offset long"
    )
    ranked = tokens.join(starts, ["part", "remainder"]).withColumns(
        {"rank": F.col("first") + F.col("place"), "base": F.col("base") + F.col("whole_before") + packed}
    )
    # At most twice as many patterns as there are lengths: a few MB for any input.
    found = ranked.join(F.broadcast(pattern), (F.col("remainder") == F.col("length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left")
    placed = found.select(
        "id", "ids", "doc_tokens", "base", F.coalesce("cut", F.lit(0)).alias("cut"), "size",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence"), "offset",
    )
    return placed.mapInArrow(_cut(capacity), "id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
