"""Token ids of whole texts by the tokenizers library, remembered for each word.

Both supported pre-tokenizers cut a text at single spaces and line ends whatever
stands around, so a piece between two of them is encoded once by the library and its
ids are reused. A text in which that isn't certain (runs of white space, special
tokens) goes to the library whole. New runs of letters go through the merges as one text,
and are told apart by the ids that begin or end a word.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa

# Words remembered before the memory starts anew (some 150 bytes each), and by a caller that has less room.
MEMORY_WORDS, FEW_WORDS = 1_000_000, 250_000
ID_BYTES = 4
# Text that callers should give at once, so that its words repeat and many are new together.
BATCH_BYTES = 2 << 20
_BATCH = 5000
# Words whose ids are gathered at a time.
_GATHERED = 1 << 18
# Letters that normalising and lower case leave as letters.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")
# The pattern's part for marks; those of ASCII are told apart where a vocabulary has it.
_OTHERS = r"[^\s\p{L}\p{N}]+"
_MARKS, _ANY_MARKS = "[,.;:!?]?", r"[!-/:-@\[-`{-~]*"


def byte_signs() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


_SPACE = byte_signs()[ord(" ")]
# A space between runs stays one.
_SIGNS = byte_signs() | {ord(" "): " "}


class WordEncoder:
    """Ids as little-endian unsigned 32-bit integers, exactly those the library gives for the whole text."""

    def __init__(self, path: str, words: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.split = self._splitter(spec)
        # The merges alone, for runs of letters with a space between two; the model is the library's, not a copy.
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.bytewise = self._bytewise(spec)
        marks = _ANY_MARKS if self.split is _spaced or _OTHERS in spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", "") else _MARKS
        # A word as it is remembered: what stands before it in place of a space, letters, marks up to the next white space.
        self.word = re.compile(f"([\r\n]?)([{_LETTERS}]+)({marks})").fullmatch
        self.borders = self._borders(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.known: dict[str, bytes | None] = {}
        self.most = words

    @staticmethod
    def _splitter(spec: dict):
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        parts = pre.get("pretokenizers", [])
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return _spaced
        steps = [step.get("type") for step in (norm or {}).get("normalizers", [])]
        drops = parts and parts[0].get("type") == "Split" and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
        if drops and r"\s" in json.dumps(parts[0]["pattern"]) and set(steps) <= {"NFC", "Replace", "Lowercase"}:
            return _bare
        return None

    @staticmethod
    def _bytewise(spec: dict) -> bool:
        """Whether a letter is spelled as its bytes."""
        pre = spec.get("pre_tokenizer") or {}
        last = [pre, *pre.get("pretokenizers", [])][-1]
        return last.get("type") == "ByteLevel" and not last.get("add_prefix_space")

    def _borders(self, spec: dict) -> np.ndarray:
        """For each id whether it begins a word after a space, or ends a word where white space is dropped."""
        names, suffix = spec["model"]["vocab"] if self.split else {}, spec["model"].get("end_of_word_suffix")
        out = np.zeros(max(names.values(), default=-1) + 1, bool)
        for name, i in names.items():
            out[i] = name.startswith(_SPACE) if self.split is _spaced else bool(suffix) and name.endswith(suffix)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(text) if self.split and not self._has_special(text) else None for text in texts]
        # Each distinct word is looked up once, and its ids are gathered by its places.
        told = pa.array(list(chain.from_iterable(filter(None, split))), pa.string()).dictionary_encode()
        distinct, codes = told.dictionary.to_numpy(zero_copy_only=False).tolist(), told.indices.to_numpy()
        known = self.known
        found = list(map(known.get, distinct))
        wanted = [word for word, ids in zip(distinct, found, strict=True) if ids is None]
        if len(known) + len(wanted) > (self.most or MEMORY_WORDS):
            known.clear()
        self._learn(wanted)
        found = [known[word] if ids is None else ids for word, ids in zip(distinct, found, strict=True)]
        stops = np.cumsum([len(words or ()) for words in split], dtype=np.int64)
        # A word whose ids depend on what stands around it.
        unsure = np.flatnonzero(np.array([ids is None for ids in found], bool)[codes])
        whole = {at for at, words in enumerate(split) if words is None} | set(np.searchsorted(stops, unsure, "right").tolist())
        data, borders = _gathered([ids or b"" for ids in found], codes, stops)
        return [self._plain([text])[0] if at in whole else data[borders[at] : borders[at + 1]] for at, text in enumerate(texts)]

    def _has_special(self, text: str) -> bool:
        """Whether a special token is in the text, or would be in its lower case, in which words are asked for."""
        return any(s in text or (s[:2] in text and s.lower() in text.lower()) for s in self.special)

    def _learn(self, words: list[str]) -> None:
        known, later, ask, runs, marks, told_apart = self.known, [], set(), set(), set(), self.word
        for word in words:
            if word.isalpha() and word.isascii():
                runs.add(word)
                continue
            parts = told_apart(word)
            if parts is None or not (self.bytewise or word.isascii()):
                bare = word[1:] if word[:1] in ("\n", "\r") else word
                if not bare or bare[0].isspace():
                    known[word] = None
                else:
                    ask.add(word)
                continue
            head, run, mark = parts.groups()
            mark = mark and "\r" + mark
            # After a line end letters stand as they do at the start of a text.
            core = "\r" + run if head else run
            if core not in known:
                runs.add(core)
            if mark or head == "\n":
                marks.add(mark)
                later.append((word, head == "\n", core, mark))
        ask.update(mark for mark in (*marks, "\r\n") if mark and mark not in known)
        for part in batched(ask, _BATCH):
            known.update(zip(part, self._plain([self._written(word) for word in part]), strict=True))
        first, runs = [run for run in runs if run[0] == "\r"], [run for run in runs if run[0] != "\r"]
        for part in batched(first, _BATCH):
            known.update(zip(part, self._plain(self._spelled([run[1:] for run in part]), self.merges), strict=True))
        for part in batched(runs, _BATCH):
            known.update(zip(part, self._apart(self._spelled(part, self.split is _spaced)), strict=True))
        for word, line_end, core, mark in later:
            known[word] = (known["\r\n"] if line_end else b"") + known[core] + (known[mark] if mark else b"")

    def _spelled(self, runs: Sequence[str], spaced: bool = False) -> list[str]:
        """Runs of letters in the signs of the vocabulary, each after a space if asked for."""
        told = " ".join(runs)
        if self.split is _bare:
            told = told.lower()
        if self.bytewise and not told.isascii():
            told = told.encode().decode("latin-1").translate(_SIGNS)
        return [_SPACE + run for run in told.split(" ")] if spaced else told.split(" ")

    def _apart(self, told: list[str]) -> list[bytes]:
        """Ids of each spelled run, all encoded as one text."""
        ids = np.array(self.merges.encode_batch_fast([" ".join(told)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(self.borders[ids])
        if len(at) != len(told):  # a vocabulary without such an id for some run
            return self._plain(told, self.merges)
        cuts = (ID_BYTES * at).tolist()
        cuts = [*cuts, ID_BYTES * len(ids)] if self.split is _spaced else [0, *(cut + ID_BYTES for cut in cuts)]
        data = ids.tobytes()
        return [data[low:high] for low, high in pairwise(cuts)]

    def _written(self, word: str) -> str:
        """The text that a remembered word stands for: after "\\r" as it is, after "\\n" with it, else after a space."""
        if word[0] == "\r":
            return word[1:]
        return word if word[0] == "\n" or self.split is _bare else " " + word

    def _plain(self, texts: list[str], library=None) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in (library or self.library).encode_batch_fast(texts, add_special_tokens=False)]


def _gathered(found: list[bytes], codes: np.ndarray, stops: np.ndarray) -> tuple[bytes, list[int]]:
    """The ids of the words that `codes` names in `found`, and the borders of the texts, which end before the word of their stop."""
    flat, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // ID_BYTES
    starts = np.cumsum(sizes) - sizes
    data, ends = [], np.zeros(len(codes) + 1, np.int64)
    for low in range(0, len(codes), _GATHERED):
        part = codes[low : low + _GATHERED]
        size = sizes[part]
        end = np.cumsum(size)
        ends[low + 1 : low + 1 + len(part)] = end + ends[low]
        places = np.repeat(starts[part] - (end - size), size)
        places += np.arange(len(places))
        data.append(flat[places].tobytes())
    return b"".join(data), [0, *(ID_BYTES * ends[stops]).tolist()]


def _spaced(text: str) -> list[str] | None:
    """Words that begin with a space, or with a line end; the first has "\\r" for neither."""
    if "\r" in text:
        return None
    if not text:
        return []
    words = text.replace("\n", " \n").split(" ")
    if words[0]:
        words[0] = "\r" + words[0]
    elif len(words) > 1 and text[0] == "\n":
        del words[0]
    else:
        return None
    return words


def _bare(text: str) -> list[str] | None:
    # White space to str.split, but not to the pre-tokenizer.
    if any(mark in text for mark in "\x1c\x1d\x1e\x1f\u180e"):
        return None
    # For ASCII alone, lower case is the same everywhere.
    return (text.lower() if text.isascii() else text).split()


@lru_cache(maxsize=2)
def encoder(path: str, words: int | None = None) -> WordEncoder:
    """One per worker process; `words` is how many it remembers, `MEMORY_WORDS` if not given."""
    return WordEncoder(path, words)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
