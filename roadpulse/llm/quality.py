"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is its own features and those of the
lines around it; a transition matrix ties neighbouring labels. Forward and backward
passes give each line's probability of being good, and the mean of these, weighted by
line length, is the document's score.

The field is fitted by gradient ascent on a bounded sample of labelled documents,
whose lines all take the document's label. Scoring reads every line of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import column, load, runs_of_rows, text_or_empty, without

# Bound of the training sample, in rows, and lines of a training segment.
TRAIN_DOCS = 4000
SEGMENT_LINES = 64
STEPS, RATE, PENALTY = 200, 0.1, 1e-3
FOLDS, HELD_OUT = 3, 1
_CHUNK_BYTES = 1 << 20
_LIMIT = 30.0

# Byte classes whose shares of a line are features; bytes of no class are other punctuation.
_CLASSES = ["lower", "upper", "digit", "space", "wide", "stop", "bar", "shout", "mark", "other"]


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("other"), np.uint8)
    for name, members in {
        "lower": range(97, 123),
        "upper": range(65, 91),
        "digit": range(48, 58),
        "space": b" \t\r\x0b\x0c",
        "wide": range(128, 256),
        "stop": b".,;:'\"-()?",
        "bar": b"|",
        "shout": b"!",
        "mark": b"#$%&*@^~+=<>{}[]\\/_`",
    }.items():
        for byte in members:
            table[byte] = _CLASSES.index(name)
    return table


_TABLE = _class_table()
_NAMES = [*_CLASSES, "length", "word", "repeated", "same_line"]


class Lines(NamedTuple):
    """Lines of several documents: features by row, byte lengths, and each document's first row and count."""

    own: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    count: np.ndarray


def line_features(texts: list[bytes]) -> Lines:
    """Features of every line of every text, in one pass over their joined bytes."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
    count = np.diff(np.append(first, len(starts)))
    kinds = len(_CLASSES)
    line = np.repeat(np.arange(len(starts), dtype=np.int64), lengths + 1)
    classes = _TABLE[data]
    tally = np.bincount(line * kinds + classes, minlength=len(starts) * kinds).reshape(-1, kinds).astype(np.float32)
    tally[:, _CLASSES.index("other")] -= 1  # the line end itself
    blank = (classes == _CLASSES.index("space")) | (data == 10)
    opens = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    closes = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
    home = line[opens]
    words = np.bincount(home, minlength=len(starts)).astype(np.float32)
    sums = np.concatenate(([0], np.cumsum(data.astype(np.int64) * (data + np.int64(7)))))
    code = (sums[closes] - sums[opens]) * 64 + (closes - opens)
    repeats = (code[1:] == code[:-1]) & (home[1:] == home[:-1])
    repeated = np.bincount(home[1:][repeats], minlength=len(starts)).astype(np.float32)
    line_code = sums[ends] - sums[starts]
    same = np.concatenate(([False], (line_code[1:] == line_code[:-1]) & (lengths[1:] == lengths[:-1]))) & (lengths > 0)
    same[first] = False
    bytes_ = np.maximum(lengths, 1)[:, None].astype(np.float32)
    letters = tally[:, [_CLASSES.index(c) for c in ("lower", "upper", "wide")]].sum(axis=1)
    extra = np.stack([np.log1p(lengths) / 4, letters / np.maximum(words, 1) / 4, repeated / np.maximum(words, 1), same], axis=1)
    return Lines(np.concatenate([tally / bytes_, extra], axis=1).astype(np.float32), lengths, first, count)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Own features beside those of the line before and after in the same document, and marks for their absence."""
    own = lines.own
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    some = lines.count > 0
    begin, end = lines.first[some], (lines.first + lines.count - 1)[some]
    before[begin], after[end] = 0, 0
    edge = np.zeros((len(own), 3), np.float32)
    edge[begin, 0], edge[end, 1], edge[:, 2] = 1, 1, 1
    return np.concatenate([own, before, after, edge], axis=1)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    # Log-potentials of (label before, label), 0 bad and 1 good.
    transition: np.ndarray
    # Score of a text without any byte.
    prior: float


def marginals(unary: np.ndarray, transition: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good at each line, and the expected number of each transition.

    `unary` is the log-potential of good against bad. All chains advance together,
    line by line; values are rescaled at each step.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    local = np.exp(np.stack([np.minimum(-unary, 0), np.minimum(unary, 0)], axis=1)) if len(unary) else np.empty((0, 2))
    move = np.exp(transition - transition.max())
    forward, backward = np.empty((len(unary), 2)), np.ones((len(unary), 2))
    live = [int(np.searchsorted(-count, -step, side="left")) for step in range(int(count.max(initial=0)))]
    for step, n in enumerate(live):
        at = first[:n] + step
        reach = local[at] if step == 0 else (forward[at - 1] @ move) * local[at]
        forward[at] = reach / reach.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for step in range(len(live) - 2, -1, -1):
        at = first[: live[step + 1]] + step
        ahead = local[at + 1] * backward[at + 1]
        both = forward[at][:, :, None] * move[None] * ahead[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        reach = ahead @ move.T
        backward[at] = reach / reach.sum(axis=1, keepdims=True)
    joint = forward * backward
    return joint[:, 1] / joint.sum(axis=1), pairs


def train(features: np.ndarray, labels: np.ndarray, first: np.ndarray, count: np.ndarray) -> Model:
    """Fit by Adam on the conditional likelihood of all chains; `labels` has one per line."""
    width = features.shape[1]
    if not len(features):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), 0.5)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0, 1  # the constant
    x = ((features - mean) / scale).astype(np.float32)
    inner = np.ones(len(x), bool)
    inner[first[count > 0]] = False
    after = np.flatnonzero(inner)
    seen = np.bincount(labels[after - 1] * 2 + labels[after], minlength=4).reshape(2, 2)
    theta = np.zeros(width + 4)
    mean_g, mean_sq = np.zeros_like(theta), np.zeros_like(theta)
    chains = max(len(first), 1)
    for step in range(1, STEPS + 1):
        unary = np.clip(x @ theta[:width].astype(np.float32), -_LIMIT, _LIMIT).astype(np.float64)
        good, pairs = marginals(unary, theta[width:].reshape(2, 2), first, count)
        gradient = np.concatenate([x.T @ (labels - good).astype(np.float32), (seen - pairs).ravel()]) / chains - PENALTY * theta
        mean_g = 0.9 * mean_g + 0.1 * gradient
        mean_sq = 0.99 * mean_sq + 0.01 * gradient**2
        theta += RATE * (mean_g / (1 - 0.9**step)) / (np.sqrt(mean_sq / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, theta[:width], theta[width:].reshape(2, 2), float(labels[first[count > 0]].mean()))


def score_texts(model: Model, texts: list[bytes]) -> np.ndarray:
    lines = line_features(texts)
    unary = np.clip(((with_neighbours(lines) - model.mean) / model.scale) @ model.weights, -_LIMIT, _LIMIT)
    good, _ = marginals(unary, model.transition, lines.first, lines.count)
    weight = np.add.reduceat(lines.lengths, lines.first)
    total = np.add.reduceat(good * lines.lengths, lines.first)
    return np.where(weight > 0, total / np.maximum(weight, 1), model.prior)


# ---------------------------------------------------------------------- Spark


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each training text, in segments."""
    for batch in batches:
        out, labels = [], []
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            matrix = with_neighbours(line_features([text]))
            for k in range(0, len(matrix), SEGMENT_LINES):
                out.append(matrix[k : k + SEGMENT_LINES].tobytes())
                labels.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(labels, pa.int64())], ["features", "label"])


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = TRAIN_DOCS) -> Model:
    """Fit on up to `sample` labelled rows outside the held-out fold, taken in hash order.

    Rows with a null id or label don't train; an id labelled twice counts with its
    lower label, and a row that repeats both id and text counts once. All lines of a
    chosen row train, in segments of `SEGMENT_LINES`, however long its text is: the bound
    is on the rows. At 180 bytes a line, rows of 25 lines take 18 MB on the driver. Without any labelled row the model gives 0.5 for everything.
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("long").alias("__label")).dropna()
    outside = known.filter(fold("__id") != HELD_OUT).groupBy("__id").agg(F.min("__label").alias("__label"))
    texts = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).cast("binary").alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    # Distinct rows are taken, not ids: an id may be that of any number of rows. Only hashes are sorted.
    chosen = texts.select("__id", "__hash").join(outside, "__id").distinct().orderBy(F.xxhash64("__id"), "__id", "__hash").limit(sample)
    texts = texts.join(F.broadcast(chosen), ["__id", "__hash"]).groupBy("__id", "__hash").agg(F.min("__text").alias("__text"), F.min("__label").alias("__label"))
    rows = texts.select("__text", "__label").mapInArrow(_sampler, "features binary, label long").collect()
    width = 3 * len(_NAMES) + 3
    parts = [np.frombuffer(r["features"], np.float32).reshape(-1, width) for r in sorted(rows, key=lambda r: (r["label"], bytes(r["features"])))]
    count = np.array([len(p) for p in parts], np.int64)
    values = np.array(sorted(r["label"] for r in rows), np.int64)
    return train(np.concatenate(parts) if parts else np.empty((0, width), np.float32), np.repeat(values, count), np.cumsum(count) - count, count)


def _scorer(model: Model, place: int, width: int) -> Callable:
    """The first `width` columns with the score of the text at `place`, a few texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs_of_rows(batch, place, _CHUNK_BYTES):
                texts = pc.fill_null(rows.column(place).cast(pa.binary()), b"").to_pylist()
                found = pa.array(score_texts(model, texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], found], [*rows.schema.names[:width], "__score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns with `score`, 0 to 1; null text counts as empty, and empty text gets the model's prior.

    An input column named `score` is replaced. An empty table stays empty.
    """
    docs = without(docs, {"score"})
    names = docs.columns
    frame = docs.select(*[column(c).alias(f"__{i}") for i, c in enumerate(names)])
    # A text goes to the task once: as the column that is kept, or beside it if that is no text.
    place = next((i for i, field in enumerate(docs.schema.fields) if field.name == text_col and isinstance(field.dataType, T.StringType)), len(names))
    if place == len(names):
        frame = docs.select(*[column(c).alias(f"__{i}") for i, c in enumerate(names)], text_or_empty(text_col).cast("binary").alias("__text"))
    schema = T.StructType([*frame.schema.fields[: len(names)], T.StructField("__score", T.DoubleType())])
    scored = frame.mapInArrow(_scorer(model, place, len(names)), schema)
    return scored.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(names)], F.col("__score").alias("score"))


def op8_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, load(spark, sf_dir, "labels"))
    ids = docs.select("doc_id", "text")
    scored = score(ids, model).drop("text")
    return scored.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op8_quality_crf": op8_quality_crf}
ORACLES: dict[str, str] = {}
