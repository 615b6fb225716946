"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of documents in ascending id order, little-endian:

    magic "PFR1", documents D (u32), blocks B (u32), ids N (u64), ids per block (u32)
    D document ids (i64, null as the smallest), D token counts (u32)
    B block starts (u64, from the first block)
    blocks: minimum (u32), values (u32), width (u8), exceptions E (u32),
            packed bits, E places (u32), E values (u32)

A block's minimum is subtracted from its values. They are packed at the width that a
percentile of them fits; the others stand whole in the exception list, with zeros in
their packed places. Any block can be read by its start alone.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, load, records, runs_of_rows, text_or_empty, work_folder
from roadpulse.llm.vocabulary import BATCH_BYTES, ID_BYTES, encoder, tokenizer_path

MAGIC = b"PFR1"
BLOCK_IDS = 4096
# Share of a block's values, in percent, that its width must hold.
PERCENTILE = 90
# Ids after which a task begins a new file.
FILE_IDS = 4 << 20
END_ID = 0
_HEAD, _BLOCK = struct.Struct("<4sIIQI"), struct.Struct("<IIBI")
_NULL_ID = -(1 << 63)
# Blocks unpacked and documents told at a time.
_READ_BLOCKS, _READ_ROWS = 16, 4096


# --------------------------------------------------------------------- format


def _held(width: int) -> int:
    """Bytes of the smallest unsigned integer that has so many bits."""
    return 1 if width <= 8 else 2 if width <= 16 else 4


def _pack(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    held = _held(width)
    bits = np.unpackbits(values.astype(f"<u{held}").view(np.uint8), bitorder="little").reshape(-1, 8 * held)[:, :width]
    return np.packbits(bits, bitorder="little").tobytes()


def _unpack(data: bytes, count: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(count, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    held = _held(width)
    wide = np.zeros((count, 8 * held), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide.ravel(), bitorder="little").view(f"<u{held}").astype(np.uint32)


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    bound = int(np.partition(rest, k := min(len(rest) - 1, int(len(rest) * percentile / 100)))[k])
    width = bound.bit_length()
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    outliers = rest[places]
    rest[places] = 0
    head = _BLOCK.pack(low, len(ids), width, len(places))
    return head + _pack(rest, width) + places.astype("<u4").tobytes() + outliers.astype("<u4").tobytes()


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, count, width, exceptions = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    size = (count * width + 7) // 8
    values = _unpack(data[at : at + size], count, width)
    if exceptions:
        places = np.frombuffer(data, "<u4", exceptions, at + size)
        values[places] = np.frombuffer(data, "<u4", exceptions, at + size + ID_BYTES * exceptions)
    return values + np.uint32(low)


def write_file(doc_ids: Iterable[int | None], counts: Iterable[int], ids: np.ndarray, percentile: float = PERCENTILE, block_ids: int = BLOCK_IDS) -> bytes:
    blocks = [pack_block(ids[low : low + block_ids], percentile) for low in range(0, len(ids), block_ids)]
    starts = np.cumsum([0] + [len(b) for b in blocks[:-1]]).astype("<u8") if blocks else np.empty(0, "<u8")
    names = np.fromiter((_NULL_ID if x is None else x for x in doc_ids), "<i8")
    head = _HEAD.pack(MAGIC, len(names), len(blocks), len(ids), block_ids)
    return b"".join([head, names.tobytes(), np.fromiter(counts, "<u4").tobytes(), starts.tobytes(), *blocks])


class TokenFile:
    """Reader of one file, open or as bytes: the ids of any range of places, and the documents.

    Of the file it holds what stands before the blocks, and of the blocks those it is asked for.
    """

    def __init__(self, source: bytes | pa.NativeFile):
        self.source = pa.BufferReader(source) if isinstance(source, bytes) else source
        magic, docs, blocks, self.total, self.block_ids = _HEAD.unpack(self._bytes(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        self.names = np.frombuffer(self._bytes(at, 8 * docs), "<i8")
        at += 8 * docs
        self.counts = np.frombuffer(self._bytes(at, ID_BYTES * docs), "<u4")
        at += ID_BYTES * docs
        starts = np.frombuffer(self._bytes(at, 8 * blocks), "<u8").tolist()
        first = at + 8 * blocks
        self.borders = [*(first + start for start in starts), self.source.size()]

    def _bytes(self, at: int, size: int) -> bytes:
        data = self.source.read_at(size, at)
        if len(data) < size:
            raise ValueError("a token file ends too early")
        return data

    def ids(self, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.empty(0, np.uint32)
        low, high = start // self.block_ids, (stop - 1) // self.block_ids + 1
        base = self.borders[low]
        data = self._bytes(base, self.borders[high] - base)
        parts = [unpack_block(data, border - base) for border in self.borders[low:high]]
        return np.concatenate(parts)[start - low * self.block_ids : stop - low * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, start and ids of each document; blocks are unpacked once, a few at a time."""
        at, held_from, held = 0, 0, np.empty(0, np.uint32)
        for low in range(0, len(self.names), _READ_ROWS):
            part = slice(low, low + _READ_ROWS)
            for name, count in zip(self.names[part].tolist(), self.counts[part].tolist(), strict=True):
                if at + count > held_from + len(held):
                    held_from = at // self.block_ids * self.block_ids
                    held = self.ids(held_from, min(self.total, max(at + count, held_from + _READ_BLOCKS * self.block_ids)))
                yield None if name == _NULL_ID else name, at, held[at - held_from : at - held_from + count]
                at += count


# -------------------------------------------------------------------- writing


def _writer(folder: str, vocabulary: str, end_id: int, file_ids: int, percentile: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        end, encode = np.array([end_id], "<u4").tobytes(), encoder(vocabulary).encode
        names, counts, held, number = array("q"), array("I"), bytearray(), 0

        def close():
            name = f"part-{part:08d}-{number:06d}.pfr"
            ids = np.frombuffer(held, "<u4")
            body = write_file(names, counts, ids, percentile)
            # A retried task writes the same bytes; readers only ever see whole files.
            store.create_dir(f"{base}/tmp", recursive=True)
            with store.open_output_stream(f"{base}/tmp/{name}.{attempt}") as out:
                out.write(body)
            store.move(f"{base}/tmp/{name}.{attempt}", f"{base}/files/{name}")
            row = [[name], [part], [number], [len(names)], [len(ids)], [len(body)]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["name", "part", "number", "documents", "ids", "bytes"])

        store.create_dir(f"{base}/files", recursive=True)
        for batch in batches:
            for rows in runs_of_rows(batch, 1, BATCH_BYTES):
                for doc, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist()), strict=True):
                    names.append(_NULL_ID if doc is None else doc)
                    counts.append(len(ids) // ID_BYTES + 1)
                    held += ids + end
                    if len(held) >= file_ids * ID_BYTES:
                        yield close()
                        names, counts, held, number = array("q"), array("I"), bytearray(), number + 1
        if names:
            yield close()

    return run


def _arrow_uri(session: SparkSession, folder: str) -> str:
    path = session._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(session._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    # Arrow wants the empty host of a file URI written out.
    return f"{whole.getScheme()}://{whole.getAuthority() or ''}{whole.getPath()}"


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    percentile: float = PERCENTILE,
) -> DataFrame:
    """Write all documents in ascending id order to files under `folder`/files.

    Returns a stored table with a row per file: `name`, `part`, `number`, `documents`,
    `ids`, `bytes`; names sort as the documents do. Null texts are empty and still get
    the end id; null ids come first. Rows that repeat an id stay, ordered by their text's hash.
    Only id and text are read, so other columns may have any name. An empty table
    writes no file.
    """
    target = _arrow_uri(docs.sparkSession, folder)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "name string, part long, number long, documents long, ids long, bytes long"
    return cut_lineage(ranged.mapInArrow(_writer(target, vocabulary, end_id, file_ids, percentile), schema))


# -------------------------------------------------------------------- reading


def _reader(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, before in records(batch):
                with store.open_input_file(f"{base}/files/{name}") as source:
                    found = ((doc, before + start, len(ids), zlib.crc32(ids.astype("<u4", copy=False))) for doc, start, ids in TokenFile(source).documents())
                    for rows in batched(found, _READ_ROWS):
                        columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])

    return run


def file_starts(files: DataFrame) -> DataFrame:
    """`name` and `before`, the ids in all earlier files; sums by blocks of tasks first, then within each."""
    placed = files.withColumn("__block", F.floor(F.col("part") / 1024))
    blocks = placed.groupBy("__block").agg(F.sum("ids").alias("__ids"))
    earlier = F.coalesce(F.sum("__ids").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum("ids").over(Window.partitionBy("__block").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = blocks.select("__block", earlier.alias("__base"))
    return placed.withColumn("__within", within).join(bases, "__block").select("name", (F.col("__base") + F.col("__within")).alias("before"))


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: `id`, `start` over all files, `n_tokens`, `ids_crc32`.

    Tasks open the files dealt to them and read a few blocks at a time. An empty table of files
    gives no rows.
    """
    session = files.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = file_starts(files).repartition(tasks, "name")
    return dealt.mapInArrow(_reader(_arrow_uri(session, folder)), "id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    files = write_tokens(load(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return read_tokens(files, folder).withColumnRenamed("id", "doc_id")


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
