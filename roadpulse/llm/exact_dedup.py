"""Exact deduplication by Grace hashing.

Records are partitioned by a content hash until each bucket fits an open-addressing
table that compares complete content. The first level is Spark's shuffle; buckets of
a task that still exceed the memory bound go to spill files by a freshly seeded
hash, as often as needed.

Each map task first merges its own copies, so a text that holds a third of all rows
reaches its bucket as one record for each task. Tables and spill files hold distinct
contents only.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from roadpulse.llm.common import column, load, records, runs_of_rows, text_or_empty, without

# Bytes of distinct content that one table may hold.
TABLE_BYTES = 48 << 20
# Spill files made when a bucket doesn't fit.
FAN_OUT = 16
_ROW_BYTES = 200
# Bytes of content that are rows at a time, on their way into a table and out of it.
_BATCH_BYTES = 2 << 20


class ContentTable:
    """Open addressing with linear probing; two entries are equal if their whole content is."""

    def __init__(self, capacity: int = 1024):
        self.slots = [-1] * capacity
        self.entries: list[list] = []  # content, order key, payload, count
        self.hashes: list[int] = []
        self.bytes = 0

    def add(self, content: bytes, code: int, key: tuple, payload: tuple, count: int) -> None:
        slots, mask = self.slots, len(self.slots) - 1
        at = code & mask
        while (found := slots[at]) >= 0:
            if self.hashes[found] == code and self.entries[found][0] == content:
                entry = self.entries[found]
                entry[3] += count
                if key > entry[1]:
                    entry[1], entry[2] = key, payload
                return
            at = (at + 1) & mask
        slots[at] = len(self.entries)
        self.entries.append([content, key, payload, count])
        self.hashes.append(code)
        self.bytes += len(content) + _ROW_BYTES
        if 2 * len(self.entries) > len(slots):
            self._grow()

    def _grow(self) -> None:
        slots = [-1] * (4 * len(self.slots))
        mask = len(slots) - 1
        for index, code in enumerate(self.hashes):
            at = code & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = index
        self.slots = slots


def _code(content: bytes, level: int) -> int:
    return xxhash.xxh64_intdigest(content, level)


def merged(rows: Iterable[tuple[bytes, tuple, tuple, int]], bound: int, level: int = 1) -> Iterator[list]:
    """One entry per distinct content: content, order key, payload and count."""
    rows, table = iter(rows), ContentTable()
    for content, key, payload, count in rows:
        table.add(content, _code(content, level), key, payload, count)
        if table.bytes > bound and len(table.entries) > 1:
            yield from _spilled(chain(table.entries, rows), bound, level + 1)
            return
    yield from table.entries


def _spilled(rows: Iterable, bound: int, level: int) -> Iterator[list]:
    files = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]  # noqa: SIM115
    try:
        for content, key, payload, count in rows:
            # The high bits choose the file, the low bits the slot.
            pickle.dump((content, key, payload, count), files[_code(content, level) >> 48 & FAN_OUT - 1], pickle.HIGHEST_PROTOCOL)
        for file in files:
            file.seek(0)
            yield from merged(_unspilled(file), bound, level)
            file.close()
    finally:
        for file in files:
            file.close()


def _unspilled(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _order_key(value, payload: tuple) -> tuple:
    """Largest id first; a null id loses, and the other columns break ties."""
    return (value is not None, value if value is not None else 0, repr(payload))


def _packed(schema: pa.Schema, rows: Iterable[tuple], rows_bytes: int = _BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0]) + _ROW_BYTES
        if size > rows_bytes:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return chain.from_iterable(map(records, runs_of_rows(batch, 0, _BATCH_BYTES)))


def _near(id_place: int, bound: int, schema: pa.Schema) -> Callable:
    """Merge the copies that a task reads, in tables of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            table = ContentTable()
            for batch in batches:
                for content, *payload in _rows(batch):
                    payload = tuple(payload)
                    table.add(content, _code(content, 0), _order_key(payload[id_place], payload), payload, 1)
                    if table.bytes > bound:
                        yield from table.entries
                        table = ContentTable()
            yield from table.entries

        yield from _packed(schema, ((content, count, *payload) for content, _, payload, count in entries()))

    return run


def _final(id_place: int, bound: int, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (content, _order_key(payload[id_place], tuple(payload)), tuple(payload), count)
            for batch in batches
            for content, count, *payload in _rows(batch)
        )
        found = ((content, count, hashlib.sha256(content).hexdigest(), *payload) for content, _, payload, count in merged(rows, bound))
        yield from _packed(schema, found)

    return run


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The row that stays of each group of rows with identical text, whole, with `group_size` and `text_sha256`.

    Null text counts as empty, in the comparison and in the digest (the row that
    stays still shows its null). The largest id stays, a null id only if there is no
    other; rows that share text and id are told apart by their other columns, and of
    fully repeated rows one stays. An empty table gives an empty result. Input columns
    named `group_size` or `text_sha256` are replaced.
    """
    docs = without(docs, {"group_size", "text_sha256"})
    others = [c for c in docs.columns if c != text_col]
    # Text travels once, as the compared bytes; a flag restores its nulls.
    frame = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__content"),
        *[column(c).alias(f"__{i}") for i, c in enumerate(others)],
        F.col(text_col).isNull().alias("__null"),
    )
    place = others.index(id_col)
    near = frame.limit(0).select("__content", F.lit(0).cast("long").alias("__count"), *frame.columns[1:]).schema
    combined = frame.mapInArrow(_near(place, table_bytes, to_arrow_schema(near)), near)
    last = combined.limit(0).select("__content", "__count", F.lit("").alias("__sha"), *frame.columns[1:]).schema
    whole = combined.repartition(F.xxhash64("__content")).mapInArrow(_final(place, table_bytes, to_arrow_schema(last)), last)
    back = {c: F.col(f"__{i}") for i, c in enumerate(others)}
    back[text_col] = F.when(~F.col("__null"), F.col("__content").cast("string"))
    return whole.select(*[back[c].alias(c) for c in docs.columns], F.col("__count").alias("group_size"), F.col("__sha").alias("text_sha256"))


def assignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document, dropped ones too: id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Groups come from `survivors`; documents find theirs by digest, in a plain join
    that adaptive execution can split where one text is hot. Of rows that repeat both
    id and text one is kept.
    """
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    groups = survivors(slim, "__id", "__text", table_bytes).select(F.col("__id").alias("keep_id"), "group_size", "text_sha256")
    own = slim.select("__id", F.sha2(text_or_empty("__text"), 256).alias("text_sha256")).groupBy("__id", "text_sha256").count()
    return (
        own.join(groups, "text_sha256")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
        .select(
            F.col("__id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return assignments(load(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
QUERIES = {"op7_exact_dedup": op7_exact_dedup}
ORACLES = {"op7_exact_dedup": ORACLE}
