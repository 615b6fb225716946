"""Encoding, token files, packing and compiled counts against the library itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadpulse.llm import packing, token_counts, token_files, vocabulary
from roadpulse.llm.common import runs_of_rows
from roadpulse.llm.vocabulary import WordEncoder, tokenizer_path
from roadpulse.session import work_folder

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
PARTS = [*"ab,.'s1 \n\t\r\x0bé!<|rveldtm-", "  ", "\n\n", "'ll", "'re", "'ve", "<|endoftext|>", "<|startoftext|>", " ", " ", "\x1c", "\x85"]
PARTS += ["ß", "İ", "́", "क़", "Σ", "中", "\U0001f44d", "᠎", "the", " the", " Word,", "ing.", "क़"]


def odd_texts(many, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25))) for _ in range(many)]


def library_ids(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_matches_the_library(path):
    texts = [*odd_texts(3000, 1), "word, word. Word " * 5000, ""]
    coder = WordEncoder(path)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)] == library_ids(path, texts)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_letter_and_mark_matches_the_library(path):
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{a}{b}{a} {a}{m}\n{b}{a}{m}{n}\n{a}" for a, b, m, n in zip(letters * 3, letters[7:] + letters * 3, marks * 99, marks[5:] + marks * 99, strict=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in WordEncoder(path).encode(texts)] == library_ids(path, texts)


class Counting:
    """A tokenizer that counts the texts it is asked for."""

    def __init__(self, library):
        self.library, self.asked = library, 0

    def encode_batch_fast(self, texts, **options):
        self.asked += len(texts)
        return self.library.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_new_words_go_to_the_library_together(path):
    draw = random.Random(5)
    words = list({"".join(draw.choices("abcdeéß", k=9)) for _ in range(20000)})
    texts = [" ".join(words[low : low + 100]) + draw.choice([".", " &&&", "%%%!"]) for low in range(0, len(words), 100)]
    coder = WordEncoder(path)
    coder.library, coder.merges = Counting(coder.library), Counting(coder.merges)
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)] == library_ids(path, texts)
    # A first word is asked for by itself; 19,000 others were before.
    assert coder.library.asked + coder.merges.asked < 1000


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memory_of_words_starts_anew(path, monkeypatch):
    monkeypatch.setattr(vocabulary, "MEMORY_WORDS", 40)
    coder, texts = WordEncoder(path), [*odd_texts(300, 4), "the cat, the\nmat. The cat" * 3]
    for low in range(0, len(texts), 7):
        part = texts[low : low + 7]
        assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(part)] == library_ids(path, part)


def test_rows_are_dealt_by_their_bytes():
    texts = ["", "a" * 5, "é" * 4, "", "b" * 40, "c", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["id", "text"])
    assert [part.column(0).to_pylist() for part in runs_of_rows(batch, 1, 10)] == [[0, 1, 2], [3, 4], [5, 6]]
    assert [part.column(0).to_pylist() for part in runs_of_rows(batch.slice(2, 4), 1, 8)] == [[2], [3, 4], [5]]
    assert not list(runs_of_rows(batch.slice(7), 1, 10))


def test_compiled_counts_match_the_library():
    texts = [*odd_texts(4000, 2), "a" * 3000, "word, word. Word " * 5000, "\n" * 99, ""]
    for states in (50, token_counts.MAX_STATES):
        coder = token_counts.CompiledTokenizer(BYTE, states)
        assert coder.count(texts).tolist() == [len(x) for x in library_ids(BYTE, texts)]


def test_chunks_compose():
    draw = np.random.default_rng(3)
    classes = draw.integers(0, 11, 5000).astype(np.uint8)
    whole = token_counts.word_starts(classes, 5000)
    for chunk in (1, 2, 7, 64):
        assert (token_counts.word_starts(classes, chunk) == whole).all()


@pytest.mark.parametrize("width", [0, 1, 5, 16, 31, 32])
def test_blocks_round_trip(width):
    draw = np.random.default_rng(width)
    for count in (1, 7, 8, 1000):
        ids = draw.integers(0, 1 << width, count, dtype=np.uint64).astype(np.uint32)
        ids[draw.integers(0, count, count // 10)] = 2**32 - 1
        for percentile in (0, 50, 90, 100):
            assert (token_files.unpack_block(token_files.pack_block(ids, percentile)) == ids).all()


def test_file_reads_any_range():
    ids = np.random.default_rng(4).integers(0, 50000, 999).astype(np.uint32)
    body = token_files.write_file([3, None, 8], [500, 1, 498], ids, block_ids=64)
    file = token_files.TokenFile(body)
    for low, high in ((0, 999), (63, 65), (64, 64), (990, 999)):
        assert (file.ids(low, high) == ids[low:high]).all()
    assert [(d, s, len(x)) for d, s, x in file.documents()] == [(3, 0, 500), (None, 500, 1), (8, 501, 498)]


def test_reader_holds_a_few_blocks_of_a_large_file(tmp_path):
    """A file of 512 Ki ids, half of them in documents of one token: not all documents or blocks at once."""
    import tracemalloc

    import pyarrow as pa

    many = 1 << 18
    counts = np.r_[np.ones(many, int), np.full(512, many // 512)]
    ids = np.random.default_rng(7).integers(0, 50000, 2 * many).astype(np.uint32)
    path = tmp_path / "part.pfr"
    path.write_bytes(token_files.write_file(range(len(counts)), counts, ids))
    store = tmp_path / "files"
    store.mkdir()
    path.rename(store / "a.pfr")
    rows = pa.RecordBatch.from_pydict({"name": ["a.pfr"], "before": [5]})
    checks, tokens, most = [], 0, 0
    tracemalloc.start()
    try:
        for batch in token_files._reader(f"file://{tmp_path}")(iter([rows])):
            most = max(most, batch.num_rows)
            tokens += sum(batch.column(2).to_pylist())
            checks.append((batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py(), batch.column(3)[-1].as_py()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert tokens == len(ids) and most <= token_files._READ_ROWS
    ends = np.cumsum(counts)
    for doc, start, check in checks:
        assert start == 5 + ends[doc] - counts[doc] and check == zlib.crc32(ids[start - 5 : ends[doc]])
    assert peak < 10 << 20


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*odd_texts(60, 5), None, "", "repeat", "repeat", "many words here " * 6000]
    rows = [(None if k == 7 else 1000 - k - (k == 3), t, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)


def test_token_files(spark, docs):
    folder = work_folder(spark)
    files = token_files.write_tokens(docs, folder, BYTE, file_ids=100)
    assert files.count() > 4
    got = sorted(token_files.read_tokens(files, folder).collect(), key=lambda r: r["start"])
    rows = docs.collect()
    want = {}
    for row, ids in zip(rows, library_ids(BYTE, [r["text"] or "" for r in rows]), strict=True):
        want.setdefault(row["doc_id"], []).append(zlib.crc32(np.array([*ids, 0], "<u4").tobytes()))
    assert [r["id"] for r in got] == sorted((r["doc_id"] for r in rows), key=lambda x: -1 if x is None else x)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    for row in got:
        want[row["id"]].remove(row["ids_crc32"])
    assert not any(want.values())


def test_packing(docs):
    got = packing.pack(docs, WORD, capacity=64).collect()
    rows = docs.collect()
    want = {}
    for row, ids in zip(rows, library_ids(WORD, [r["text"] or "" for r in rows]), strict=True):
        want.setdefault(row["doc_id"], []).append([*ids, 2])
    sequences, pieces = {}, {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts[:-1]]).tolist() and sum(n for _, n in parts) <= 64
    for doc, texts in want.items():
        if len(texts) == 1:
            assert sum((ids for _, ids, _ in sorted(pieces[doc])), []) == texts[0]
            assert {n for _, _, n in pieces[doc]} == {len(texts[0])}
    padding = sum(64 - sum(n for _, n in parts) for parts in sequences.values())
    assert padding <= 64 + len(sequences) * (packing.LEAST_GAP - 1)


def test_patterns_cover_every_rank():
    draw = random.Random(6)
    for _ in range(60):
        capacity = draw.choice([8, 16, 100])
        histogram = {draw.randint(1, capacity - 1): draw.randint(1, 40) for _ in range(draw.randint(1, 20))}
        cover, room = {}, {}
        for s in packing.slots(histogram, capacity, draw.choice([1, 3])):
            for rank in range(s.low, s.high):
                cover.setdefault((s.length, rank), []).append((s.cut, s.size))
                room.setdefault(s.sequence + rank - s.low, []).append((s.offset, s.size))
        assert set(cover) == {(length, rank) for length, n in histogram.items() for rank in range(n)}
        for (length, _), parts in cover.items():
            parts.sort()
            assert [c for c, _ in parts] == np.cumsum([0] + [z for _, z in parts[:-1]]).tolist() and sum(z for _, z in parts) == length
        assert all(sum(z for _, z in parts) <= capacity for parts in room.values())


def test_counts_of_rows(docs):
    got = token_counts.token_counts(docs.withColumn("n_bytes", F.lit("mine")), BYTE, limit=10).collect()
    rows = docs.collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids)) for r, ids in zip(rows, library_ids(BYTE, [r["text"] or "" for r in rows]), strict=True)]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in got)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert token_files.write_tokens(none, work_folder(spark), BYTE).isEmpty()
    assert packing.pack(none, WORD).isEmpty()
    assert token_counts.token_counts(none, BYTE).isEmpty()


def test_no_files_give_no_rows(spark, docs):
    folder = work_folder(spark)
    files = token_files.write_tokens(docs.limit(0), folder, BYTE)
    assert token_files.read_tokens(files, folder).isEmpty()
