"""Spelling variants against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import variants

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs, least=5, every=199):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def got(df, **options):
    return {r["word"]: tuple(r)[1:] for r in variants.spelling_variants(df, **options).collect()}


def documents(seed):
    """Few letters, so that lists are long, and words spelled in several ways."""
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcé") for _ in range(draw.randint(6, 10))) for _ in range(25)]
    words = list(stems)
    for stem in stems * 4:
        at = draw.randrange(len(stem) + 1)
        words.append(draw.choice([stem[:at] + draw.choice("abcdéz") + stem[at:], stem[:at] + stem[at + 1 :], stem[:at] + "a" + stem[at + 1 :]]))
    rows = [(k, " ".join(draw.choices(words, weights=[60] * 25 + [1 + i % 7 for i in range(len(words) - 25)], k=150)).title()) for k in range(30)]
    return [*rows, (7, rows[7][1]), (None, rows[3][1]), (31, None), (32, ""), (33, "× ÷ 12 漢字abcdefg-Ünï" * 5)]


@pytest.mark.parametrize("options", [{}, {"heavy": 3, "longest_list": 2}, {"heavy": 0, "longest_list": 1000}, {"every": 3}, {"heavy": 10, "longest_list": 1}])
def test_equals_comparison_of_all_words(spark, options):
    docs = documents(len(options))
    want = expected(docs, every=options.get("every", 199))
    assert any(v[0] for v in want.values()) and any(v[3] > 3 for v in want.values())
    assert got(spark.createDataFrame(docs, SCHEMA), **options) == want


def test_given_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    want = expected([tuple(r) for r in docs.collect()])
    assert len(want) > 100
    rows = variants.op11_spelling_variants(spark, data).collect()
    assert {r["word"]: tuple(r)[1:] for r in rows} == want


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaa": 5, "aaaaab": 26, "aaaabb": 140, "aaabbb": 800, "zzzzzz": 9}
    docs = [(0, " ".join(w for w, n in counts.items() for _ in range(n)))]
    rows = got(spark.createDataFrame(docs, SCHEMA), every=1 << 33)
    assert {w: r[:2] for w, r in rows.items()} == {
        "aaaaaa": ("aaaaab", "aaabbb"), "aaaaab": ("aaaabb", "aaabbb"), "aaaabb": ("aaabbb", "aaabbb"), "aaabbb": (None, "aaabbb"), "zzzzzz": (None, "zzzzzz")
    }


def test_bound_holds_for_every_edit():
    draw = random.Random(4)
    for _ in range(300):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(6, 11)))
        heavy = {u[p : p + q]: 9 for u in [f"^{word}$"] for q in (2, 3) for p in range(len(u) - q + 1) if draw.random() < 0.6}
        spans = variants.grams(word, heavy)
        bound = variants.affected(spans, len(word) + 2)
        assert len(spans) > bound
        at = draw.randrange(len(word) + 1)
        other = draw.choice([word[:at] + "x" + word[at:], word[:at] + word[at + 1 :], word[:at] + "x" + word[at + 1 :]])
        keys = {k for k, _ in variants.signatures(word, heavy, 5)}
        if len(other) >= 6 and other != word:
            others = {k for k, _ in variants.signatures(other, heavy, 5)}
            assert keys & others, (word, other)


def test_no_words(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    assert got(spark.createDataFrame([(1, None), (None, "..."), (2, "short words do not take part")], SCHEMA)) == {}
    with pytest.raises(ValueError):
        variants.spelling_variants(spark.createDataFrame([], SCHEMA), shortest=5)


def test_other_columns_and_long_texts(spark):
    docs = [(1, "lantern lanterm " * 40_000), (2, "lantern")]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"word": F.lit("x"), "n": F.lit(1), "key": F.lit(2)})
    assert got(df, every=1 << 33) == {"lantern": (None, "lantern", 40_001, 1, None), "lanterm": (None, "lanterm", 40_000, 1, None)}
