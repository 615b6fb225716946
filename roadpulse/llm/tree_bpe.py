"""BPE encoding by tree concatenation, and decoding.

A long text is cut into leaves without regard to words. The leaves are encoded in
parallel, each as if it stood alone; a leaf that more text follows leaves its last word
open (no end-of-word mark). Nodes of the tree are then joined, sixteen at a time in one
task and level by level in Spark: a few tokens on both sides of a join are taken back
into text and encoded anew, and the window grows until its first token is the left side's
and its last word, or token inside a word, is the right side's. Sixteen leaves travel
together and are joined where they are encoded, and a text climbs no more levels than its
own length asks for, however long others are.

Why that is exact. Merging takes the pair of lowest rank, leftmost first, so a row of
tokens encodes a word if and only if any two neighbours encode what they spell: merges
inside a pair's text don't depend on what is outside until one crosses its border. The
pairs inside either side and inside the window are right by themselves, and the agreeing
tokens make the two pairs between them right as well. Words are cut by a forward scan
that looks at most two code points ahead, so a scan that meets a border of another one
goes on like it; windows start and end far enough from an apostrophe and from the cut.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import column, load, runs_of_rows, text_or_empty
from roadpulse.llm.vocabulary import BATCH_BYTES, FEW_WORDS, encoder, tokenizer_path

# Code points of a leaf; shorter texts are one leaf.
LEAF = 8192
# Nodes joined in one task at each level.
FAN_IN = 16
# Tokens first taken back on each side of a join.
WINDOW = 8
# Bytes that the scan for words can look ahead: three code points.
_AHEAD = 12
_SPACE = 0x20


class Node:
    """A slice of a text: its normalised bytes, its ids, and whether the text ends here."""

    __slots__ = ("closed", "ids", "text")

    def __init__(self, text: bytes, ids: array, closed: bool):
        self.text, self.ids, self.closed = text, ids, closed


class TreeEncoder:
    """Ids of the tokenizers library for a vocabulary whose words carry an end mark and whose white space is dropped."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if not suffix or not steps or steps[0].get("behavior") != "Removed" or not steps[0].get("invert"):
            raise ValueError(f"{path}: tree concatenation needs an end-of-word mark and words without white space")
        self.words = encoder(path, FEW_WORDS)
        self.library = self.words.library
        # The model is the library's, not a copy.
        self.scan = Tokenizer(self.library.model)
        self.scan.pre_tokenizer = self.library.pre_tokenizer
        plain = spec | {"normalizer": None, "added_tokens": []}
        bare = plain | {"pre_tokenizer": steps[-1], "model": spec["model"] | {"end_of_word_suffix": None}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        size = max(spec["model"]["vocab"].values(), default=-1) + 1
        size = max([size] + [t["id"] + 1 for t in spec.get("added_tokens", [])])
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        self.names = names
        self.ends = [name.endswith(suffix) for name in names]
        # A sign of the byte-level alphabet stands for one byte.
        self.width = [len(name.removesuffix(suffix)) for name in names]
        self.special = {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        for i, content in self.special.items():
            self.ends[i], self.width[i] = True, len(content.encode())
        found = sorted(self.special.values(), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, found))) if found else None

    # Leaves

    def slices(self, text: str, leaf: int) -> list[str]:
        """The text in pieces of about `leaf` code points that can be normalised apart, and cut no special token."""
        spans = [m.span() for m in self.marks.finditer(text)] if self.marks else []
        out, low, at = [], 0, 0
        while low < len(text):
            high = low + leaf
            while high < len(text):
                while at < len(spans) and spans[at][1] <= high:
                    at += 1
                if at < len(spans) and spans[at][0] < high:
                    high = spans[at][1]
                elif _joins_back(text[high]):
                    high += 1
                else:
                    break
            out.append(text[low:high])
            low = high
        return out or [""]

    def normal(self, text: str) -> bytes:
        """Normalised text between the special tokens, which stay as they are."""
        out, low = [], 0
        for mark in self.marks.finditer(text) if self.marks else ():
            out += [self._normal(text[low : mark.start()]), mark.group()]
            low = mark.end()
        return "".join([*out, self._normal(text[low:])]).encode()

    def _normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer and text else text

    def leaves(self, parts: list[tuple[str, bool]]) -> list[Node]:
        """Nodes of raw slices, each with whether its text ends there."""
        out = []
        for (part, closed), ids in zip(parts, self.words.encode([part for part, _ in parts]), strict=True):
            text = self.normal(part)
            ids = array("I", ids)
            out.append(Node(text, ids if closed else self._opened(text, ids), closed))
        return out

    def twigs(self, runs: list[tuple[list[str], bool]]) -> list[Node]:
        """Nodes of runs of raw slices, each with whether its text ends there; all leaves are encoded at once."""
        leaves = iter(self.leaves([(part, closed and k == len(parts)) for parts, closed in runs for k, part in enumerate(parts, 1)]))
        return [self.join_all(list(islice(leaves, len(parts)))) for parts, _ in runs]

    def _opened(self, text: bytes, ids: array) -> array:
        """Ids of a text that goes on: the last word, if it touches the end, without its end mark."""
        if not ids or text[-1] == _SPACE or ids[-1] in self.special:
            return ids
        at, size = len(ids) - 1, self.width[ids[-1]]
        while at and not self.ends[ids[at - 1]]:
            at -= 1
            size += self.width[ids[at]]
        return ids[:at] + self._ids(self.bare, text[len(text) - size :])

    @staticmethod
    def _ids(tokenizer, text: bytes) -> array:
        return array("I", tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids)

    def _window(self, text: bytes, closed: bool) -> array:
        ids = self._ids(self.scan, text)
        return ids if closed else self._opened(text, ids)

    # Joins

    def join(self, left: Node, right: Node) -> Node:
        """The node of both slices, with the ids that the library gives for their text."""
        a, b = left.ids, right.ids
        # Tokens between the last special token of the left and the first of the right, and their text.
        first, low = self._run_back(left)
        last, high = self._run_ahead(right)
        closed = last < len(b) or right.closed
        text = left.text + right.text
        if first == len(a) and low == len(left.text):
            return Node(text, a + b, right.closed)
        back = ahead = WINDOW
        while True:
            i, s = self._start(left, first, low, back)
            j, e, shut = self._end(right, last, high, closed, ahead)
            new = self._window(left.text[s:] + right.text[:e], shut)
            agrees_left = i == first or (len(new) > 0 and new[0] == a[i])
            agrees_right = j == last or self._agrees(b, j, new, shut)
            if agrees_left and agrees_right:
                return Node(text, a[:i] + new + b[j:], right.closed)
            back, ahead = (back if agrees_left else 2 * back), (ahead if agrees_right else 2 * ahead)

    def _run_back(self, node: Node) -> tuple[int, int]:
        """First token after the node's last special token, and the byte where its text starts."""
        ids = node.ids
        for at in range(len(ids) - 1, -1, -1) if self._has_special(ids) else ():
            if ids[at] in self.special:
                return at + 1, self._position(node, at + 1)
        return 0, 0

    def _run_ahead(self, node: Node) -> tuple[int, int]:
        """Tokens before the node's first special token, and the byte where it starts."""
        ids = node.ids
        if self._has_special(ids):
            at = next(k for k, i in enumerate(ids) if i in self.special)
            pos = self._walk(node.text, ids, at)
            while node.text[pos] == _SPACE:
                pos += 1
            return at, pos
        return len(ids), len(node.text)

    def _has_special(self, ids: array) -> bool:
        return any(i in ids for i in self.special)

    def _walk(self, text: bytes, ids: array, n: int) -> int:
        """Byte after the first n tokens."""
        pos = 0
        for i in ids[:n]:
            while text[pos] == _SPACE:
                pos += 1
            pos += self.width[i]
        return pos

    def _position(self, node: Node, at: int) -> int:
        """Byte after the token before `at`, counted from the end."""
        text, pos = node.text, len(node.text)
        for i in reversed(node.ids[at:]):
            while text[pos - 1] == _SPACE:
                pos -= 1
            pos -= self.width[i]
        while at and pos and text[pos - 1] == _SPACE:
            pos -= 1
        return pos

    def _start(self, node: Node, first: int, low: int, back: int) -> tuple[int, int]:
        """A place at least `back` tokens before the end where a window may start."""
        text, ids = node.text, node.ids
        at, pos = len(ids), len(text)
        while at > first:
            at -= 1
            while text[pos - 1] == _SPACE:
                pos -= 1
            pos -= self.width[ids[at]]
            if len(ids) - at < back or at == first or pos + _AHEAD > len(text):
                continue
            if self.ends[ids[at - 1]] or self._inside(text, pos, pos + 1):
                return at, pos
        return first, low

    def _end(self, node: Node, last: int, high: int, closed: bool, ahead: int) -> tuple[int, int, bool]:
        """A place at least `ahead` tokens after the start where a window may end, and whether a word ends there."""
        text, ids = node.text, node.ids
        pos = words = 0
        for at in range(last):
            while text[pos] == _SPACE:
                pos += 1
            pos += self.width[ids[at]]
            done = at + 1
            words += self.ends[ids[at]]
            if done < ahead or done == last:
                continue
            if self.ends[ids[at]]:
                if words > 1:
                    return done, pos, True
            elif pos >= _AHEAD and self._inside(text, pos, pos + _AHEAD):
                return done, pos, False
        return last, high, closed

    @staticmethod
    def _inside(text: bytes, pos: int, until: int) -> bool:
        """Whether a run of letters or of signs can be cut here: between code points, with no apostrophe near."""
        return text[pos] & 0xC0 != 0x80 and b"'" not in text[max(0, pos - _AHEAD) : until]

    def _agrees(self, ids: array, j: int, new: array, shut: bool) -> bool:
        """Whether the window's end has the right side's tokens: its last word whole with the mark before it, or its last token."""
        from_ = j - 1
        if shut:
            from_ -= 1
            while not self.ends[ids[from_]]:
                from_ -= 1
        return len(new) >= j - from_ and new[from_ - j :] == ids[from_:j]

    def join_all(self, nodes: list[Node]) -> Node:
        """A binary tree over the nodes."""
        while len(nodes) > 1:
            pairs = [self.join(*nodes[i : i + 2]) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[2 * len(pairs) :]
        return nodes[0]

    def packed(self, ids: array) -> bytes:
        """Ids for the way between tasks, in two bytes each where the vocabulary allows it."""
        return array("H", ids).tobytes() if len(self.names) <= 1 << 16 else ids.tobytes()

    def unpacked(self, ids: bytes) -> array:
        return array("I", array("H", ids)) if len(self.names) <= 1 << 16 else array("I", ids)

    def decode(self, ids: array) -> str:
        """What the library's decode gives without a decoder of its own: the tokens' names, spaced."""
        return " ".join(map(self.names.__getitem__, ids))


def _joins_back(sign: str) -> bool:
    """Whether normalising may join the sign with what stands before it."""
    return sign >= "̀" and (unicodedata.category(sign)[0] == "M" or "ᄀ" <= sign <= "ᇿ")


@lru_cache(maxsize=2)
def tree_encoder(path: str) -> TreeEncoder:
    """One per worker process."""
    return TreeEncoder(path)


# Runs of sixteen leaves encoded at once.
_RUNS = BATCH_BYTES // (FAN_IN * LEAF)
# Code points that no text has.
_LONGEST = 1 << 31


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, digest: bool = False) -> DataFrame:
    """Ids of every text as the tokenizers library gives them without added special tokens.

    Returns `id` and `ids` (little-endian unsigned 32-bit integers), or with `digest` the
    columns `id`, `n_tokens`, `ids_sha256` and `decoded_sha256`. One row per input row; other
    columns are left out, whatever they are called. Null and empty texts give no ids; null and
    repeated ids are kept, and equal rows give equal rows. Texts of more than `leaf` code
    points are cut, spread over the tasks by sixteen leaves and joined again, so that a very
    long text is encoded in many tasks; its ids are in one row in the end, as its text was.
    Texts of each number of levels go their own way, so that only the longest travel more than
    once. An empty table gives an empty table.
    """
    spark = df.sparkSession
    base = df.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    out = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else f"id {kind}, ids binary"
    schema = spark.createDataFrame([], out).schema
    node = f"id {kind}, key binary, part int, closed boolean, text binary, ids binary"

    def emit(ids: list, codes: list[array]) -> pa.RecordBatch:
        return _digests(tree_encoder(path), ids, codes) if digest else _frame(ids, codes)

    def whole(batches):
        tree = tree_encoder(path)
        for batch in batches:
            for part in runs_of_rows(batch, 1, BATCH_BYTES):
                nodes = tree.words.encode(part.column(1).to_pylist())
                yield emit(part.column(0), [array("I", ids) for ids in nodes])

    def cut(batches):
        tree = tree_encoder(path)
        for batch in batches:
            for at, text in enumerate(batch.column(2)):
                parts = tree.slices(text.as_py(), leaf)
                runs = [parts[low : low + FAN_IN] for low in range(0, len(parts), FAN_IN)]
                for low in range(0, len(runs), _RUNS):
                    some = runs[low : low + _RUNS]
                    numbers = range(low, low + len(some))
                    same = pa.array([at] * len(some), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(same), batch.column(1).take(same), pa.array(numbers, pa.int32()), pa.array([k == len(runs) - 1 for k in numbers]), pa.array(some, pa.list_(pa.string()))],
                        names=["id", "key", "part", "closed", "slices"],
                    )

    def encode_leaves(last: bool):
        def run(batches):
            tree = tree_encoder(path)
            for batch in batches:
                for low in range(0, batch.num_rows, _RUNS):
                    part = batch.slice(low, _RUNS)
                    nodes = tree.twigs(list(zip(part.column(4).to_pylist(), part.column(3).to_pylist(), strict=True)))
                    if last:
                        yield emit(part.column(0), [node.ids for node in nodes])
                    else:
                        yield _nodes(tree, part.column(0), part.column(1), part.column(2).to_pylist(), nodes)

        return run

    def climb(last: bool):
        return lambda table: parent(table, last)

    def parent(table: pa.Table, last: bool) -> pa.Table:
        """Join the nodes of one parent; equal rows have equal nodes, and each keeps a row of its own."""
        tree = tree_encoder(path)
        table = table.combine_chunks()
        parts: dict[int, Node] = {}
        numbers = table.column("part").to_pylist()
        first = min(numbers)
        copies = numbers.count(first)
        for number, closed, text, ids in zip(numbers, *[table.column(c).to_pylist() for c in ("closed", "text", "ids")], strict=True):
            if number not in parts:
                parts[number] = Node(text, tree.unpacked(ids), closed)
        joined = tree.join_all([parts[number] for number in sorted(parts)])
        heads = table.slice(0, 1).take(pa.array([0] * copies, pa.int32())).combine_chunks()
        ends = [heads.column(c).chunk(0) for c in ("id", "key")]
        if last:
            return pa.Table.from_batches([emit(ends[0], [joined.ids] * copies)])
        return pa.Table.from_batches([_nodes(tree, *ends, [first // FAN_IN] * copies, [joined] * copies)])

    def grown(long: DataFrame, levels: int) -> DataFrame:
        """Texts whose tree has as many levels of joins, the first of them where the leaves are encoded."""
        # The rows of a text find each other by its hash; the id keeps equal texts of different rows apart.
        keyed = long.select("id", F.unhex(F.md5("text")).alias("key"), "text")
        runs = keyed.mapInArrow(cut, f"id {kind}, key binary, part int, closed boolean, slices array<string>")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        nodes = runs.repartition(tasks, "id", "key", "part").mapInArrow(encode_leaves(levels == 1), schema if levels == 1 else node)
        for level in range(2, levels + 1):
            grouped = nodes.groupBy("id", "key", F.floor(F.col("part") / FAN_IN).alias("parent"))
            nodes = grouped.applyInArrow(climb(level == levels), schema if level == levels else node)
        return nodes

    sized = base.withColumn("size", F.char_length("text"))
    found = sized.filter(F.col("size") <= leaf).select("id", "text").mapInArrow(whole, schema)
    bands, low = [], leaf
    while low < _LONGEST:
        bands.append((F.col("size") > low) & (F.col("size") <= low * FAN_IN))
        low *= FAN_IN
    texts = sized.agg(*[F.count_if(band) for band in bands]).first()
    for levels, (band, many) in enumerate(zip(bands, texts, strict=True), 1):
        if many:
            found = found.unionByName(grown(sized.filter(band), levels))
    return found


def _nodes(tree: TreeEncoder, ids: pa.Array, keys: pa.Array, numbers: list[int], nodes: list[Node]) -> pa.RecordBatch:
    columns = [
        pa.array(numbers, pa.int32()),
        pa.array([node.closed for node in nodes], pa.bool_()),
        pa.array([node.text for node in nodes], pa.binary()),
        pa.array([tree.packed(node.ids) for node in nodes], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays([ids, keys, *columns], names=["id", "key", "part", "closed", "text", "ids"])


def _frame(ids: pa.Array, codes: list[array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array([c.tobytes() for c in codes], pa.binary())], names=["id", "ids"])


def _digests(tree: TreeEncoder, ids: pa.Array, codes: list[array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([len(c) for c in codes], pa.int64()),
            pa.array([hashlib.sha256(c.tobytes()).hexdigest() for c in codes], pa.string()),
            pa.array([hashlib.sha256(tree.decode(c).encode()).hexdigest() for c in codes], pa.string()),
        ],
        names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def decode(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """`id` and `text` of every row of ids, as the library's decode gives it with special tokens kept. Null ids give empty text."""
    base = df.select(column(id_col).alias("id"), F.coalesce(column(ids_col), F.lit(b"")).alias("ids"))
    kind = base.schema["id"].dataType.simpleString()

    def texts(batches):
        tree = tree_encoder(path)
        for batch in batches:
            found = [tree.decode(array("I", ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "text"])

    return base.mapInArrow(texts, f"id {kind}, text string")


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return encode(docs, tokenizer_path("word_bpe_49k.json"), digest=True).withColumnRenamed("id", "doc_id")


QUERIES = {"op12_tree_bpe": op12_tree_bpe}
ORACLES: dict[str, str] = {}
