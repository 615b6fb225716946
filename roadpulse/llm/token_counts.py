"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic machines stand for a byte-level BPE tokenizer with the usual word
pattern. The splitter reads character classes and emits where words begin, at the
current character or the one before. Its texts are cut into chunks of equal length: all
chunks run side by side from every state, which gives a state map for each; a parallel
prefix scan composes the maps, and a second run from the now known states emits.

The counter reads the bytes of a word. Its transitions are annotated with the tokens
emitted: by how much the encoding of the word so far grows. A state is what the
future may depend on: for every place where a token could still be under way, the
place in the vocabulary's trie, the token that ends there and the count there. States
and transitions are compiled when first met, and thrown away if too many; counts
don't depend on that.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import load, text_or_empty
from roadpulse.llm.vocabulary import byte_signs, tokenizer_path

LIMIT = 512
# Counter states that a worker keeps at once.
MAX_STATES = 250_000
CHUNK_CHARS = 64
_BATCH_CHARS = 1 << 20

# ---------------------------------------------------------------- the splitter

# Character classes. The last two aren't characters: the end of a text, and filling that changes nothing.
_CLASSES = ["letter", "number", "other", "space", "white", "quote", "s t m d", "r v", "l", "e", "end", "fill"]
_LETTER, _NUMBER, _OTHER, _SPACE, _WHITE, _QUOTE, _ONE, _TWO_E, _TWO_L, _E, _END, _FILL = range(len(_CLASSES))
# States: at a word's begin; in letters, numbers, others; after one or more white characters, the last a space
# or not; after a quote that begins a word; after such a quote and a letter that may need an e, or an l.
_BEGIN, _IN_L, _IN_N, _IN_O, _SP1, _SP2, _WH1, _WH2, _AFTER_Q, _NEED_E, _NEED_L = range(11)
_HERE, _BEFORE = 1, 2


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states and emissions by state and class, for the word pattern of byte-level BPE."""
    move, emit = np.zeros((11, len(_CLASSES)), np.uint8), np.zeros((11, len(_CLASSES)), np.uint8)
    letters = (_LETTER, _ONE, _TWO_E, _TWO_L, _E)
    run = {**dict.fromkeys(letters, _IN_L), _NUMBER: _IN_N, _OTHER: _IN_O, _QUOTE: _IN_O}

    def fresh(state: int, kind: int, extra: int = 0) -> None:
        """The character begins a word, whatever was before."""
        target = {_SPACE: _SP1, _WHITE: _WH1, _QUOTE: _AFTER_Q}.get(kind, run.get(kind))
        move[state, kind], emit[state, kind] = target, _HERE | extra

    for state in range(11):
        move[state, _FILL] = state
        move[state, _END] = _BEGIN
        for kind in range(_END):
            fresh(state, kind)
    for state, kinds in ((_IN_L, letters), (_IN_N, (_NUMBER,)), (_IN_O, (_OTHER, _QUOTE))):
        for kind in kinds:
            move[state, kind], emit[state, kind] = state, 0
    for state in (_SP1, _SP2, _WH1, _WH2):
        move[state, _SPACE], emit[state, _SPACE] = _SP2, 0
        move[state, _WHITE], emit[state, _WHITE] = _WH2, 0
        for kind in run:
            if state in (_SP1, _SP2):  # the space goes with the word
                move[state, kind], emit[state, kind] = run[kind], 0 if state == _SP1 else _BEFORE
            elif state == _WH2:
                fresh(state, kind, _BEFORE)
    for kind, target in ((_ONE, _BEGIN), (_TWO_E, _NEED_E), (_TWO_L, _NEED_L), (_OTHER, _IN_O), (_QUOTE, _IN_O)):
        move[_AFTER_Q, kind], emit[_AFTER_Q, kind] = target, 0
    for state, wanted in ((_NEED_E, _E), (_NEED_L, _TWO_L)):
        for kind in range(_END):  # no contraction: the letter before began a word
            move[state, kind], emit[state, kind] = move[_IN_L, kind], emit[_IN_L, kind] | _BEFORE
        emit[state, _END] = _BEFORE
        move[state, wanted], emit[state, wanted] = _BEGIN, 0
    return move, emit


def chunk_maps(move: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For each row of classes, the state after it for every state before it."""
    states = np.broadcast_to(np.arange(len(move), dtype=np.uint8), (len(classes), len(move))).copy()
    flat, width = move.ravel(), move.shape[1]
    for step in range(classes.shape[1]):
        states = flat[states.astype(np.intp) * width + classes[:, step, None]]
        # Once every map is constant, one column stands for all.
        if step % 8 == 7 and (states == states[:, :1]).all():
            one = states[:, 0]
            for rest in range(step + 1, classes.shape[1]):
                one = flat[one.astype(np.intp) * width + classes[:, rest]]
            return np.repeat(one[:, None], len(move), axis=1)
    return states


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of all maps up to and with each, by doubling."""
    out, reach = maps.copy(), 1
    while reach < len(out):
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return out


def word_starts(classes: np.ndarray, chunk: int = CHUNK_CHARS) -> np.ndarray:
    """Whether a word begins at each character; `classes` ends every text with its end class."""
    move, emit = _splitter_tables()
    rows = -(-len(classes) // chunk)
    grid = np.full(rows * chunk, _FILL, np.uint8)
    grid[: len(classes)] = classes
    grid = grid.reshape(rows, chunk)
    after = prefix_scan(chunk_maps(move, grid))
    states = np.concatenate(([_BEGIN], after[:-1, _BEGIN])).astype(np.intp)
    flat_move, flat_emit, width = move.ravel().astype(np.intp), emit.ravel(), move.shape[1]
    marks = np.empty((rows, chunk), np.uint8)
    for step in range(chunk):
        at = states * width + grid[:, step]
        marks[:, step] = flat_emit[at]
        states = flat_move[at]
    marks = marks.ravel()[: len(classes)]
    begins = (marks & _HERE).astype(bool)
    begins[:-1] |= (marks[1:] & _BEFORE).astype(bool)
    return begins


@lru_cache(maxsize=1)
def _splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    return splitter()


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, as the tokenizers library tells letters, numbers and white space apart."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    table = np.full(0x110000, _OTHER, np.uint8)
    # Planes beyond the third hold no letter, number or white space.
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _WHITE)):
        for _, (low, high) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            table[points[low] : points[high - 1] + 1] = kind
    for members, kind in ((" ", _SPACE), ("'", _QUOTE), ("stmd", _ONE), ("rv", _TWO_E), ("l", _TWO_L), ("e", _E)):
        for char in members:
            table[ord(char)] = kind
    return table


# ----------------------------------------------------------------- the counter


class Counter:
    """Transducer over the bytes of one word; every state may end."""

    def __init__(self, spec: dict, max_states: int = MAX_STATES):
        letters = byte_signs()
        back = {letter: byte for byte, letter in letters.items()}
        vocabulary = spec["model"]["vocab"]
        self.base = [vocabulary[letters[b]] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.order: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.rank[pair] = rank
            if whole not in self.parts:
                self.parts[whole], self.order[whole] = pair, rank
        # A trie over the bytes of all tokens: children of each node, and the token that ends there.
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        special = {t["id"] for t in spec.get("added_tokens", [])}
        for text, token in vocabulary.items():
            if token in special:
                continue
            node = 0
            for letter in text:
                byte = back[letter]
                below = self.child[node].get(byte)
                if below is None:
                    below = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = below
            self.token[node] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.max_states = max_states
        self._reset()

    def _reset(self) -> None:
        self.items: list[tuple] = []
        self.number: dict[tuple, int] = {}
        # Only bytes that were met have a column.
        self.column, self.bytes = np.zeros(256, np.int64), []
        self.next = np.full((1024, 64), -1, np.int32)
        self.emits = np.zeros((1024, 64), np.int8)
        self._state(((0, -1, 0),))

    def _grow(self, rows: int, columns: int) -> None:
        old_next, old_emits = self.next, self.emits
        self.next, self.emits = np.full((rows, columns), -1, np.int32), np.zeros((rows, columns), np.int8)
        self.next[: old_next.shape[0], : old_next.shape[1]] = old_next
        self.emits[: old_emits.shape[0], : old_emits.shape[1]] = old_emits

    def _meet(self, data: np.ndarray) -> None:
        for byte in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if byte not in self.bytes:
                if len(self.bytes) == self.next.shape[1]:
                    self._grow(len(self.next), 2 * len(self.bytes))
                self.column[byte] = len(self.bytes)
                self.bytes.append(byte)

    def _state(self, items: tuple) -> int:
        found = self.number.get(items)
        if found is None:
            found = self.number[items] = len(self.items)
            self.items.append(items)
            if found >= len(self.next):
                self._grow(found * 3 // 2, self.next.shape[1])
        return found

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens on one edge of a token's merges, each with the rank at which it is merged further."""
        key = (token, side)
        if key not in self.spines:
            out, until = [], float("inf")
            while True:
                out.append((token, until))
                if token not in self.parts:
                    break
                until, token = self.order[token], self.parts[token][side]
            self.spines[key] = out
        return self.spines[key]

    def _fit(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: no merge over their border comes before both sides are merged on.

        Merges are applied by rank and from the left, and a token is only merged after it was made.
        """
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            found = True
            if left >= 0:
                for a, until_a in self._spine(left, 1):
                    for b, until_b in self._spine(right, 0):
                        rank = self.rank.get((a, b))
                        if rank is not None and rank < until_a and rank <= until_b:
                            found = False
                            break
                    if not found:
                        break
            self.fits[key] = found
        return found

    def _compile(self, state: int, byte: int) -> None:
        ahead, last, grown = [], -1, 0
        for node, before, count in self.items[state]:
            below = self.child[node].get(byte)
            if below is None:
                continue
            token = self.token[below]
            if token >= 0 and last < 0 and self._fit(before, token):
                last, grown = token, count + 1
            if self.child[below]:
                ahead.append((below, before, count))
        items = tuple((node, before, count - grown) for node, before, count in ahead)
        target = self._state((*items, (0, last, 0)))
        column = self.column[byte]
        self.next[state, column], self.emits[state, column] = target, grown

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each word of `data`; all words run side by side."""
        if len(self.items) > self.max_states:
            self._reset()
        self._meet(data)
        columns = self.column[data]
        width = self.next.shape[1]
        order = np.argsort(-lengths, kind="stable")
        at, sizes = starts[order], lengths[order]
        states, totals = np.zeros(len(order), np.int64), np.zeros(len(order), np.int32)
        live = len(order)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes[:live], -step, side="left"))
            states = states[:live]
            place = states * width + columns[at[:live] + step]
            reached = self.next.ravel()[place]
            while (missing := np.flatnonzero(reached < 0)).size:
                for key in np.unique(place[missing]).tolist():
                    self._compile(key // width, self.bytes[key % width])
                reached = self.next.ravel()[place]
            totals[:live] += self.emits.ravel()[place]
            states = reached.astype(np.int64)
        out = np.empty_like(totals)
        out[order] = totals
        return out


class CompiledTokenizer:
    def __init__(self, path: str, max_states: int = MAX_STATES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE with the usual word pattern can be compiled")
        self.counter = Counter(spec, max_states)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special token's string counts one and parts the text."""
        out = np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0
        for k, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                out[k] += len(parts) - 1
            for part in parts:
                held.append(part)
                owners.append(k)
                size += len(part) + 1
            if size >= _BATCH_CHARS:
                self._add(held, owners, out)
                held, owners, size = [], [], 0
        self._add(held, owners, out)
        return out

    def _add(self, parts: list[str], owners: list[int], out: np.ndarray) -> None:
        if not any(parts):
            return
        # The end class takes the place of a newline put after each part.
        whole = "\n".join(parts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        classes = class_table()[points]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(sizes) - 1
        classes[ends] = _END
        begins = word_starts(classes)
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        offset = np.cumsum(wide) - wide
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        chars = np.flatnonzero(begins)
        # A word ends where the next one begins, or at its part's end.
        home = np.searchsorted(ends, chars)
        stop = np.minimum(np.append(chars[1:], len(points)), ends[home])
        starts = offset[chars]
        found = self.counter.counts(data, starts, offset[stop] - starts)
        np.add.at(out, np.asarray(owners)[home], found)


@lru_cache(maxsize=1)
def compiled(path: str) -> CompiledTokenizer:
    """One per worker process."""
    return CompiledTokenizer(path)


# ---------------------------------------------------------------------- Spark


def _tally(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = compiled(path).count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts)], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, `n_bytes` of its UTF-8, `n_tokens`, and `over_limit`.

    Null text counts as empty: no bytes and no tokens. Null and repeated ids are
    counted like any other row. Only id and text are read. An empty table gives no row.
    """
    text = text_or_empty(text_col)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = slim.mapInArrow(_tally(vocabulary), "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLES: dict[str, str] = {}
