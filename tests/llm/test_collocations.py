"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import collocations

SCHEMA = "text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, longest=4, top=2000, cover=80):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            parts = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * found[q] >= cover * a for q in parts):
                continue
            cut = min((collocations.SCALE * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            scored.append((-cut[0], -a, " ".join(p).encode(), cut))
        for rank, (score, a, phrase, cut) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, cut[2], cut[3], totals[lang], -score))
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


def corpus(seed, size=60):
    draw = random.Random(seed)
    words = ["the", "of", "and", "Red", "é", "x" * 40, "uné", "a\x00b", "ÉTÉ", "q'q"]
    passage = " ".join(f"p{i}" for i in range(12))
    rows = []
    for k in range(size):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "; "]) for _ in range(40))
        rows.append((text + (f" {passage} " if k % 2 else "") + " red red red red red", draw.choice(["en", "en", "fr", None, "und"])))
    return [*rows, (None, "en"), ("", None), (" \t.,", "fr"), ("once only here", "xx")]


@pytest.mark.parametrize(("least", "options"), [(3, {}), (10, {}), (5, {"top": 7}), (4, {"longest": 3}), (4, {"longest": 2}), (6, {"cover": 101}), (3, {"cover": 50, "longest": 5})])
def test_equals_counting(spark, least, options):
    rows = corpus(least)
    want = expected(rows, least, **options)
    assert len(want) > 5
    assert got(spark.createDataFrame(rows, SCHEMA), least=least, **options) == want


def test_small_blocks_and_bitmaps_change_nothing(spark, monkeypatch):
    rows = corpus(9)
    for name, value in {"WORD_BITS": 15, "PAIR_BITS": 15, "BLOCK_WORDS": 50}.items():
        monkeypatch.setattr(collocations, name, value)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), least=4) == expected(rows, 4)


def test_counts_above_a_byte(spark):
    rows = [("new york city " * 300, "en")]
    assert got(spark.createDataFrame(rows, SCHEMA), least=290) == expected(rows, 290)


def test_paths_are_whole_passages(spark):
    rows = [("a b c d e f g. x b c d e y", "en")] * 4 + [("q r s t", "en")] * 3
    singles = collocations.word_counts(spark.createDataFrame(rows, "text string, lang string").select("lang", "text"))
    assert {r["phrase"]: r["n"] for r in singles.collect()}["b"] == 8
    grams = [("en", 4, "a b c d", 4), ("en", 4, "b c d e", 8), ("en", 4, "c d e f", 4), ("en", 4, "d e f g", 4), ("en", 4, "x b c d", 4), ("en", 4, "c d e y", 4),
             ("en", 4, "q r s t", 3), ("en", 3, "e f g", 4), ("en", 3, "d e y", 4), ("en", 3, "r s t", 3)]
    counts = collocations.node_counts(spark.createDataFrame(grams, "lang string, size int, phrase string, n long"), 4)
    threes = {r["phrase"]: r["n"] for r in counts.filter("size = 3").collect()}
    assert threes["b c d"] == 8 and threes["c d e"] == 8 and threes["d e f"] == 4 and threes["e f g"] == 4
    paths = {(r["path"], r["n"]) for r in collocations.unary_paths(counts, 4).collect()}
    assert paths == {("a b c d", 4), ("x b c d", 4), ("b c d e", 8), ("c d e f g", 4), ("c d e y", 4), ("q r s t", 3)}


def test_products_beyond_64_bits(spark):
    counts = [("en", "a b", 1, 10**16), ("en", "c d", 1, 9 * 10**17)]
    df = spark.createDataFrame(counts, "lang string, phrase string, x int, a long")
    score = F.expr(f"(cast(a as decimal(20,0)) * {collocations.SCALE}) div (cast(a as decimal(20,0)) + a + 1)")
    assert [r[0] for r in df.select(score).collect()] == [2_000_000 * a // (2 * a + 1) for _, _, _, a in counts]


def test_nothing_to_find(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame(corpus(1, 3), SCHEMA), least=1000) == []
    with pytest.raises(ValueError):
        collocations.collocations(spark.createDataFrame([], SCHEMA), longest=1)


def test_other_columns(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"phrase": F.lit("x"), "n": F.lit(1), "rank": F.lit(2), "size": F.lit(3)})
    assert got(df, least=5) == expected(rows, 5)
