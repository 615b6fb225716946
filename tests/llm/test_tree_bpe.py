"""Tree concatenation against the tokenizers library on whole texts."""

import hashlib
import random
from array import array

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import tree_bpe
from roadpulse.llm.vocabulary import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
SIGNS = [
    [*"abcdefgthein'''srelv!?.,-  \n\t0123", "é", "é", "́", "H", "İ", "̱", "ß", "Σ", "漢", "ㅏ", "ᅡ", "각", "👍🏽", "\x1c", " ", "'re", "'ll",
     "<|endoftext|>", "<|ENDOFTEXT|>", "the", "ing", "thing"],
    list("abcdefghij"), ["a"], ["a", "b"], ["th", "he", "in", "g"], ["'", "r", "e", "s", "l", " "], ["!", "'", ".", "''"],
    ["<|endoftext|>", "<|ENDOFTEXT|>", " ", "'ll", "a"], ["漢", "é", "á", "a", "İ"],
]


@pytest.fixture(scope="module")
def tree():
    return tree_bpe.tree_encoder(PATH)


@pytest.mark.parametrize("kind", range(len(SIGNS)))
def test_any_cut_gives_the_ids_of_the_whole(tree, monkeypatch, kind):
    draw = random.Random(kind)
    for _ in range(400):
        text = "".join(draw.choice(SIGNS[kind]) for _ in range(draw.randint(0, 90)))
        monkeypatch.setattr(tree_bpe, "WINDOW", draw.choice([1, 2, 8]))
        parts = tree.slices(text, draw.randint(1, 30))
        assert "".join(parts) == text
        node = tree.join_all(tree.leaves([(part, i == len(parts) - 1) for i, part in enumerate(parts)]))
        want = tree.library.encode(text, add_special_tokens=False).ids
        assert list(node.ids) == want, (text, parts)
        assert tree.decode(node.ids) == tree.library.decode(want, skip_special_tokens=False)


def test_windows_stay_small_in_one_long_word(tree, monkeypatch):
    draw = random.Random(1)
    text = "".join(draw.choice("etaoinshr") for _ in range(200_000))
    parts = tree.slices(text, 4096)
    nodes = tree.leaves([(part, i == len(parts) - 1) for i, part in enumerate(parts)])
    read = []
    window = tree._window
    monkeypatch.setattr(tree, "_window", lambda text, closed: read.append(len(text)) or window(text, closed))
    assert list(tree.join_all(nodes).ids) == tree.library.encode(text, add_special_tokens=False).ids
    assert sum(read) < 10_000


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_of_every_kind(spark, tree):
    long = "Some WORDS of it's own<|endoftext|> and " * 300
    texts = [None, "", "  \n", "short", long, long + "x", "a" * 5000, "<|startoftext|>" * 500]
    rows = [(k, t) for k, t in enumerate(texts)] + [(4, long), (4, long + "other"), (None, long), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "ids": F.lit(1), "key": F.lit(2), "part": F.lit(3), "size": F.lit(0)})
    want = []
    for doc, text in rows:
        ids = tree.library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, array("I", ids).tobytes()))
    for leaf in (50, 700, 100_000):
        got = tree_bpe.encode(df, PATH, leaf=leaf)
        assert sorted(((r["id"], bytes(r["ids"])) for r in got.collect()), key=repr) == sorted(want, key=repr), leaf
    back = tree_bpe.decode(tree_bpe.encode(df, PATH, leaf=700), PATH)
    assert told(back) == sorted(((doc, tree.library.decode(list(array("I", ids)), skip_special_tokens=False)) for doc, ids in want), key=repr)
    assert tree_bpe.encode(df.limit(0), PATH).count() == 0


def shuffled(plan):
    """Bytes that the exchanges of a plan wrote when it ran."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled(plan.children().apply(k)) for k in range(plan.children().size()))


def test_a_text_travels_as_its_own_length_asks(spark, tree):
    """One text of several levels sends no other text through them, and texts of one level travel once."""
    draw = random.Random(2)
    texts = ["".join(draw.choice("etaoinshrdlucmfwyp 0123456789") for _ in range(n)) for n in [4000] * 60 + [9000, 120_000]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tree_bpe.encode(df, PATH, leaf=400)
    want = [(k, array("I", tree.library.encode(text, add_special_tokens=False).ids).tobytes()) for k, text in enumerate(texts)]
    assert sorted((r["id"], bytes(r["ids"])) for r in got.collect()) == want
    once = sum(map(len, texts[:60]))
    sent = shuffled(got._jdf.queryExecution().executedPlan())
    assert 0 < sent < once + 6 * sum(map(len, texts[60:]))


def test_given_table(spark, data, tree):
    want = []
    for doc, text in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        ids = tree.library.encode(text or "", add_special_tokens=False).ids
        text = tree.library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert told(tree_bpe.op12_tree_bpe(spark, data)) == sorted(want, key=repr)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tree_bpe.TreeEncoder(tokenizer_path("byte_bpe_50k.json"))


def test_few_words_are_remembered_and_models_are_shared(monkeypatch):
    monkeypatch.setattr(tree_bpe, "FEW_WORDS", 300)
    tree, draw = tree_bpe.TreeEncoder(PATH), random.Random(3)
    for _ in range(40):
        texts = [" ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(20)) for _ in range(5)]
        assert [list(node.ids) for node in tree.leaves([(text, True) for text in texts])] == [tree.library.encode(text, add_special_tokens=False).ids for text in texts]
        assert len(tree.words.known) <= 400
    # What is set on a model that two tokenizers share is seen by both.
    tree.library.model.unk_token = "a"
    assert tree.scan.model.unk_token == tree.words.merges.model.unk_token == "a"
    assert tree.bare.model.unk_token is None
