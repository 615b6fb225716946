"""Document log-likelihood under a gated recurrent language model.

The output is factored: first a class of words, then the word. Frequent words have
classes of their own with a softmax inside; all other words fall into classes by
their first two bytes, inside which a word has its smoothed share of the class's
training tokens. So every word has a probability, seen or not, and only the sequence
of frequent words and classes runs through the network.

Counts are taken over all training documents. The network is trained by truncated
backpropagation in numpy where the data lie. Every training document is trained on
once, whole: a hash of its text says in which round, and the parameters are averaged
over tasks after each round. In training and in scoring, documents run side by side in
lanes, and a lane's state is carried from window to window to the end of the document.

Counts of frequent words are broadcast, up to a bound. Rarer words are joined to the
table of all counts.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import cut_lineage, load, text_or_empty

HIDDEN = 16
# Words with an output of their own, words to a class, classes for all others.
HEAD_WORDS, CLASS_WORDS, TAIL_CLASSES = 512, 32, 32
# Words whose counts every task gets, and the longest such word in bytes.
KNOWN_WORDS, KNOWN_BYTES = 200_000, 48
WINDOW = 32
LANES, TRAIN_LANES = 512, 256
# Rounds of training; each document is in one of them.
ROUNDS = 2
# Updates that a task makes in a round, at least, if it has the symbols for it.
UPDATES = 60
RATE = 0.01
SMOOTHING = 0.1
FOLDS, HELD_OUT = 10, 0
# The end of a text; no word is empty.
END = b""
_CHUNK_TOKENS = 4_000_000
_SYMBOL_BYTES = 2
_COUNTER_WORDS = 400_000
_TREE = 32
_LOG10 = np.log(10.0)
# Biases are log-probabilities, so logits are near or below zero; exp of this is still finite.
_MOST = 80.0


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


# ----------------------------------------------------------------- vocabulary


class Places(dict):
    """Places of words; -1 for all others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Vocabulary(NamedTuple):
    """What tasks know of the words; arrays are by place in `place`, frequent words first."""

    tokens: int  # N
    types: int  # V
    place: Places
    head: int
    symbol: np.ndarray
    base: np.ndarray
    inside: np.ndarray
    prefix: dict[bytes, int]
    # Training tokens and words of each tail class.
    mass: np.ndarray
    kinds: np.ndarray
    head_counts: np.ndarray

    @property
    def head_classes(self) -> int:
        return -(-self.head // CLASS_WORDS)

    def tail(self, word: bytes) -> int:
        return self.prefix.get(word[:2], 0)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task with their counts, in parts of bounded size."""
    held: Counter[bytes] = Counter()

    def part():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

    for batch in batches:
        for text in batch.column(0):
            held.update(words_of(text.as_py()))
            held[END] += 1
            if len(held) > _COUNTER_WORDS:
                yield part()
                held.clear()
    if held:
        yield part()


def count_words(training: DataFrame) -> DataFrame:
    """`word` and `c` over all texts, ends included."""
    return cut_lineage(training.select("text").mapInArrow(_counter, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = totals["n"], totals["v"]
    short = counts.filter(F.length("word").between(1, KNOWN_BYTES))
    # The least count that leaves few enough words, from the numbers of words by size of count.
    step = F.floor(F.log2("c") * 8)
    sizes = {r["step"]: r["k"] for r in short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, words = 1 << 60, 0
    for size in sorted(sizes, reverse=True):
        words += sizes[size]
        if words > KNOWN_WORDS:
            break
        least = size
    ranked = [(bytes(r["word"]), r["c"]) for r in short.filter(step >= least).collect()]
    ranked.sort(key=lambda r: (-r[1], r[0]))
    ends = counts.filter(F.length("word") == 0).first()
    ranked.insert(0, (END, ends["c"] if ends else 0))
    head = min(HEAD_WORDS, len(ranked))
    # Two bytes: at most 65,792 different beginnings.
    begins = counts.filter(F.length("word") > 0).groupBy(F.substring("word", 1, 2).alias("p")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k"))
    sums = {bytes(r["p"]): [r["c"], r["k"]] for r in begins.collect()}
    for word, c in ranked[1:head]:
        sums[word[:2]][0] -= c
        sums[word[:2]][1] -= 1
    largest = sorted(sums, key=lambda p: (-sums[p][0], p))[: TAIL_CLASSES - 1]
    prefix = {p: k + 1 for k, p in enumerate(largest)}
    mass, kinds = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for p, (c, k) in sums.items():
        mass[prefix.get(p, 0)] += c
        kinds[prefix.get(p, 0)] += k
    c = np.array([r[1] for r in ranked], np.float64)
    symbol = np.array([k if k < head else head + prefix.get(w[:2], 0) for k, (w, _) in enumerate(ranked)], np.int32)
    tail = np.maximum(symbol - head, 0)
    inside = np.where(np.arange(len(c)) < head, 0.0, np.log10((c + SMOOTHING) / (mass + SMOOTHING * (kinds + 1))[tail]))
    base = np.log10((c + SMOOTHING) / (n + SMOOTHING * (v + 1)))
    return Vocabulary(n, v, Places((w, k) for k, (w, _) in enumerate(ranked)), head, symbol, base, inside, prefix, mass, kinds, c[:head])


# -------------------------------------------------------------------- network


class Net:
    """Parameters in one flat vector; the arrays are views of it."""

    def __init__(self, vocab: Vocabulary, flat: np.ndarray | None = None):
        symbols, h, c = vocab.head + TAIL_CLASSES, HIDDEN, vocab.head_classes
        shapes = {
            "into": (symbols, 3 * h), "back": (h, 3 * h), "classes": (h, c + TAIL_CLASSES), "class_bias": (c + TAIL_CLASSES,),
            "words": (c, h, CLASS_WORDS), "word_bias": (c, CLASS_WORDS),
        }
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(size, np.float32) if flat is None else flat
        self.head, self.at = vocab.head, {}
        low = 0
        for name, shape in shapes.items():
            high = low + int(np.prod(shape))
            self.at[name] = self.flat[low:high].reshape(shape)
            low = high
        if flat is None:
            self._begin(vocab)

    def _begin(self, vocab: Vocabulary) -> None:
        """Small random weights, and biases that alone give the frequencies of classes and words."""
        draw = np.random.default_rng(1)
        for name in ("into", "back", "classes", "words"):
            self.at[name][...] = draw.normal(0, 0.1, self.at[name].shape)
        counts = np.zeros(vocab.head_classes * CLASS_WORDS)
        counts[: vocab.head] = vocab.head_counts + SMOOTHING
        by_class = counts.reshape(-1, CLASS_WORDS)
        sizes = np.concatenate([by_class.sum(axis=1), vocab.mass + SMOOTHING * (vocab.kinds + 1)])
        self.at["class_bias"][...] = np.log(sizes / sizes.sum())
        with np.errstate(divide="ignore"):
            self.at["word_bias"][...] = np.maximum(np.log(by_class / by_class.sum(axis=1, keepdims=True)), -30.0)


def run_states(net: Net, x: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States before each target: after reading x[t], with the state cleared where a text begins.

    Inside, and in what is kept, lanes are the last axis, so that gates are contiguous.
    """
    h, into, back = HIDDEN, np.ascontiguousarray(net.at["into"].T), np.ascontiguousarray(net.at["back"].T)
    out, kept = np.empty((*x.shape, h), np.float32), []
    live, state = (~fresh).astype(np.float32), np.ascontiguousarray(state.T)
    for t in range(len(x)):
        before = state * live[t]
        gates, rec = into.take(x[t], axis=1), back @ before
        zr = gates[: 2 * h]
        zr += rec[: 2 * h]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:h], zr[h:]
        new = r * rec[2 * h :]
        new += gates[2 * h :]
        np.tanh(new, out=new)
        state = before - new
        state *= z
        state += new
        out[t] = state.T
        if keep:
            kept.append((before, z, r, new, rec[2 * h :]))
    return out, kept


def run_output(net: Net, states: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each target symbol; with `grads`, adds to them and gives the states' gradient."""
    c = net.at["words"].shape[0]
    own = np.where(target < net.head, target // CLASS_WORDS, c + target - net.head).astype(np.int16)
    # By class, so that the targets of a class are one slice.
    order = np.argsort(own, kind="stable")
    own, states, target = own[order], states[order], target[order]
    logits = states @ net.at["classes"]
    logits += net.at["class_bias"]
    np.minimum(logits, _MOST, out=logits)
    rows = np.arange(len(target))
    picked = logits[rows, own]
    np.exp(logits, out=logits)
    total = logits.sum(axis=1)
    logp = picked - np.log(total)
    down = None
    if grads is not None:
        logits *= (-1 / total)[:, None]
        logits[rows, own] += 1
        down = logits @ net.at["classes"].T
        grads["classes"] += states.T @ logits
        grads["class_bias"] += logits.sum(axis=0)
    cuts = np.searchsorted(own, np.arange(c + 1))
    for k in range(c):
        at = slice(cuts[k], cuts[k + 1])
        part = states[at]
        if not len(part):
            continue
        inner = part @ net.at["words"][k]
        inner += net.at["word_bias"][k]
        np.minimum(inner, _MOST, out=inner)
        mine, lines = target[at] % CLASS_WORDS, rows[: len(part)]
        chosen = inner[lines, mine]
        np.exp(inner, out=inner)
        sums = inner.sum(axis=1)
        logp[at] += chosen - np.log(sums)
        if grads is not None:
            inner *= (-1 / sums)[:, None]
            inner[lines, mine] += 1
            down[at] += inner @ net.at["words"][k].T
            grads["words"][k] += part.T @ inner
            grads["word_bias"][k] += inner.sum(axis=0)
    back = np.empty_like(order)
    back[order] = rows
    return logp[back], None if down is None else down[back]


def gradients(net: Net, x: np.ndarray, target: np.ndarray, valid: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple[Net, np.ndarray, float]:
    """Gradient of the mean log-probability over one window, the state after it, and that mean."""
    h = HIDDEN
    states, kept = run_states(net, x, fresh, state, keep=True)
    grad = Net.__new__(Net)
    grad.flat, grad.head = np.zeros_like(net.flat), net.head
    grad.at, low = {}, 0
    for name, values in net.at.items():
        grad.at[name] = grad.flat[low : low + values.size].reshape(values.shape)
        low += values.size
    real = np.flatnonzero(valid.ravel())
    logp, down = run_output(net, states.reshape(-1, h)[real], target.ravel()[real], grad.at)
    below = np.zeros((x.size, h), np.float32)
    below[real] = down
    below = below.reshape(*x.shape, h)
    carry, live = np.zeros((h, x.shape[1]), np.float32), (~fresh).astype(np.float32)
    back = net.at["back"]
    at_gates, at_rec = np.empty((*x.shape, 3 * h), np.float32), np.empty((3 * h, x.shape[1]), np.float32)
    for t in range(len(x) - 1, -1, -1):
        before, z, r, new, rec = kept[t]
        d = carry
        d += below[t].T
        held = d * z
        d -= held
        d_new = 1 - new * new
        d_new *= d
        d_z, d_r = at_rec[:h], at_rec[h : 2 * h]
        np.subtract(before, new, out=d_z)
        d_z *= held
        d_z *= 1 - z
        np.multiply(d_new, r, out=at_rec[2 * h :])
        np.multiply(at_rec[2 * h :], rec, out=d_r)
        d_r *= 1 - r
        at_gates[t, :, : 2 * h] = at_rec[: 2 * h].T
        at_gates[t, :, 2 * h :] = d_new.T
        grad.at["back"] += before @ at_rec.T
        carry = back @ at_rec
        carry += held
        carry *= live[t]
    # Sums by symbol over sorted rows.
    order = np.argsort(x.ravel().astype(np.int16), kind="stable")
    ranked = x.ravel()[order]
    begins = np.flatnonzero(np.diff(ranked, prepend=-1))
    grad.at["into"][ranked[begins]] += np.add.reduceat(at_gates.reshape(-1, 3 * h)[order], begins, axis=0)
    grad.flat /= max(len(real), 1)
    return grad, states[-1], float(logp.mean()) if len(real) else 0.0


# ---------------------------------------------------------------------- lanes


def lanes(texts: list[np.ndarray], many: int) -> list[list[int]]:
    """Texts dealt to lanes, longest first, each to the lane with the least."""
    heap = [(0, k) for k in range(min(many, len(texts)))]
    out: list[list[int]] = [[] for _ in heap]
    for text in sorted(range(len(texts)), key=lambda k: -len(texts[k])):
        length, lane = heapq.heappop(heap)
        out[lane].append(text)
        heapq.heappush(heap, (length + len(texts[text]), lane))
    return sorted(out, key=lambda lane: -sum(len(texts[k]) for k in lane))


def windows(texts: list[np.ndarray], many: int, end: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Inputs, targets, validity, text begins and owners of each window over all lanes that still run.

    The input before a text's first symbol is the end symbol; lanes run longest first,
    so those that have ended are the last.
    """
    dealt = lanes(texts, many)
    if not dealt:
        return
    order = np.concatenate([np.array(lane) for lane in dealt])
    lengths = np.array([len(texts[k]) for k in order])
    symbols, owners = np.concatenate([texts[k] for k in order]), np.repeat(order, lengths)
    begins = np.diff(owners, prepend=-1) != 0
    earlier = np.where(begins, end, np.concatenate([[end], symbols[:-1]]))
    sizes = np.array([sum(len(texts[k]) for k in lane) for lane in dealt])
    starts = np.cumsum(sizes) - sizes
    for low in range(0, int(sizes.max()), WINDOW):
        live = int(np.searchsorted(-sizes, -low, side="left"))
        step = low + np.arange(WINDOW)[:, None]
        valid = step < sizes[:live]
        place = np.where(valid, starts[:live] + step, 0)
        yield np.where(valid, earlier[place], end), np.where(valid, symbols[place], end), valid, valid & begins[place], np.where(valid, owners[place], -1)


def log_likelihoods(net: Net, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each text's symbols, the state carried over its windows."""
    out, state = np.zeros(len(texts)), None
    for x, target, valid, fresh, owner in windows(texts, LANES, 0):
        state = np.zeros((x.shape[1], HIDDEN), np.float32) if state is None else state[: x.shape[1]]
        states, _ = run_states(net, x, fresh, state)
        state = states[-1]
        real = np.flatnonzero(valid.ravel())
        logp, _ = run_output(net, states.reshape(-1, HIDDEN)[real], target.ravel()[real])
        out += np.bincount(owner.ravel()[real], weights=logp, minlength=len(texts))
    return out


def train(net: Net, texts: list[np.ndarray]) -> int:
    """One pass of Adam over the texts by truncated backpropagation; the number of symbols seen."""
    total = sum(map(len, texts))
    # Enough updates even on little data.
    many = int(np.clip(total // (WINDOW * UPDATES), 8, TRAIN_LANES))
    first, second = np.zeros_like(net.flat), np.zeros_like(net.flat)
    state, step = None, 0
    for x, target, valid, fresh, _ in windows(texts, many, 0):
        state = np.zeros((x.shape[1], HIDDEN), np.float32) if state is None else state[: x.shape[1]]
        grad, state, _ = gradients(net, x, target, valid, fresh, state)
        step += 1
        first += 0.1 * (grad.flat - first)
        second += 0.01 * (grad.flat**2 - second)
        net.flat += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return total


# ---------------------------------------------------------------------- Spark


def _texts(symbols: Iterator[bytes]) -> Iterator[list[np.ndarray]]:
    """Texts as rows of symbols, in lists of bounded size; a longer text is a list of its own."""
    held, size = [], 0
    for row in symbols:
        held.append(np.frombuffer(row, np.int16).astype(np.int64))
        size += len(held[-1])
        if size > _CHUNK_TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _trainer(shared, flat: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Net(shared.value, flat.copy()), 0
        for held in _texts(row for batch in batches for row in batch.column(0).to_pylist()):
            seen += train(net, held)
        if seen:
            yield _weighed(net.flat.astype(np.float64) * seen, seen)

    return run


def _weighed(values: np.ndarray, weight: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary()), pa.array([weight], pa.int64())], ["flat", "weight"])


def _adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0
    for batch in batches:
        for flat, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            values = np.frombuffer(flat)
            total, weight = values if total is None else total + values, weight + w
    if total is not None:
        yield _weighed(total, weight)


def _average(parts: DataFrame) -> np.ndarray | None:
    """Weighted mean of all tasks' parameters, summed in a tree so that few rows reach the driver."""
    parts = cut_lineage(parts)
    rows = parts.count()
    while rows > _TREE:
        parts = cut_lineage(parts.repartition(-(-rows // _TREE)).mapInArrow(_adder, "flat binary, weight long"))
        rows = parts.count()
    found = parts.collect()
    if not found:
        return None
    return (sum(np.frombuffer(r["flat"]) for r in found) / sum(r["weight"] for r in found)).astype(np.float32)


def fit(encoded: DataFrame, vocab: Vocabulary, shared) -> np.ndarray:
    """Parameters trained on the `symbols` of the training texts; without any, those of plain frequencies."""
    flat = Net(vocab).flat
    for turn in range(ROUNDS):
        part = encoded.filter(~F.col("held_out") & (F.col("turn") == turn)).select("symbols")
        averaged = _average(part.mapInArrow(_trainer(shared, flat), "flat binary, weight long"))
        flat = flat if averaged is None else averaged
    return flat


def _symbols(vocab: Vocabulary, words: list[bytes], places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Symbols of the words, and the words without a place."""
    symbols = vocab.symbol[places]
    odd = np.flatnonzero(places < 0).tolist()
    others = [words[k] for k in odd]
    if odd:
        symbols[odd] = [vocab.head + vocab.tail(w) for w in others]
    return symbols, others


_ENCODED = (
    "part long, line long, id long, held_out boolean, turn int, n_tokens long, n_known long, base double, inside double, symbols binary, "
    "rare array<struct<word:binary,times:long,class:long>>"
)


def _encoder(shared) -> Callable:
    """Each text as symbols (two bytes each), with what its known words add to the scores and its other words."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
    names = ["part", "line", "id", "held_out", "turn", "n_tokens", "n_known", "base", "inside", "symbols", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = shared.value
        part, line = TaskContext.get().partitionId(), 0
        # Without training texts even the end is unknown.
        first_known = 0 if vocab.head_counts[0] > 0 else 1
        find = vocab.place.__getitem__

        def done() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            kinds = pa.array([vocab.tail(w) for w in rare], pa.int64())
            each = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64()), kinds], ["word", "times", "class"])
            return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), each)], names)

        rows, size, rare, times, cuts = [], 0, [], [], [0]
        for batch in batches:
            for doc, held, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = words_of(text)
                words.append(END)
                places = np.fromiter(map(find, words), np.int64, len(words))
                symbols, others = _symbols(vocab, words, places)
                seldom = Counter(others)
                rare.extend(seldom)
                times.extend(seldom.values())
                cuts.append(len(rare))
                found = places[places >= 0]
                known, base, inside = int((found >= first_known).sum()), float(vocab.base[found].sum()), float(vocab.inside[found].sum())
                turn = zlib.crc32(text) % ROUNDS
                rows.append((part, line, doc, held, turn, len(words), known, base, inside, symbols.astype(np.int16).tobytes()))
                line += 1
                size += len(words)
                if size > _CHUNK_TOKENS:
                    yield done()
                    rows, size, rare, times, cuts = [], 0, [], [], [0]
        if rows:
            yield done()

    return run


def _scorer(shared, flat: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(shared.value, flat)
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = [np.frombuffer(row, np.int16).astype(np.int64) for row in table.column("symbols").to_pylist()]
            scores = pa.array(log_likelihoods(net, texts) / _LOG10, pa.float64())
            return table.drop_columns("symbols").append_column("network", scores).to_batches()[0]

        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
                if size > _SYMBOL_BYTES * _CHUNK_TOKENS:
                    yield done()
                    held, size = [], 0
        if held:
            yield done()

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: `id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Null texts are empty and have one token, the end. Rows with a null id hash as an
    empty id. Repeated rows are scored, and counted in training, each. Only id and text
    are read. An empty table gives no row; without training rows every word is
    equally unknown. A very long text runs through one lane of one task, window after
    window, since its state is carried from its first word to its last.

    Each text is split into words twice, for the counts and for its symbols; training and
    scoring read the symbols.
    """
    spark = docs.sparkSession
    slim = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).cast("binary").alias("text")
    )
    training = slim.filter(~F.col("held_out"))
    counts = count_words(training)
    vocab = vocabulary(counts)
    # Bounded by the numbers and bytes of known words above.
    shared = spark.sparkContext.broadcast(vocab)
    encoded = cut_lineage(slim.mapInArrow(_encoder(shared), _ENCODED))
    flat = fit(encoded, vocab, shared)
    kept = ["part", "line", "id", "held_out", "n_tokens", "n_known", "base", "inside"]
    schema = "part long, line long, id long, held_out boolean, n_tokens long, n_known long, base double, inside double, network double"
    scored = encoded.select(*kept, "symbols").mapInArrow(_scorer(shared, flat), schema)
    # Rare words: their counts come from the table of all counts.
    inside = F.array(*[F.lit(float(m + SMOOTHING * (k + 1))) for m, k in zip(vocab.mass, vocab.kinds, strict=True)])
    rare = encoded.select("part", "line", F.explode("rare").alias("r")).select("part", "line", "r.word", "r.times", F.col("r.class").alias("class"))
    c = F.coalesce("c", F.lit(0))
    sums = (
        rare.join(counts, "word", "left")
        .groupBy("part", "line")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10((c + SMOOTHING) / F.lit(vocab.tokens + SMOOTHING * (vocab.types + 1)))).alias("more_base"),
            F.sum(F.col("times") * F.log10((c + SMOOTHING) / F.element_at(inside, (F.col("class") + 1).cast("int")))).alias("more_score"),
        )
    )
    return scored.join(sums, ["part", "line"], "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("network") + F.col("inside") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def op2_gru_scores(spark, sf_dir: str) -> DataFrame:
    return score(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op2_gru_scores": op2_gru_scores}
ORACLES: dict[str, str] = {}
