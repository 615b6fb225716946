"""Exact deduplication, SimHash groups, source mixing: edge cases and brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadpulse.llm import components, exact_dedup, mixing, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long text " * 30_000
ROWS = [
    (1, "same", "en", "a", 4),
    (5, "same", None, "b", 4),
    (3, "same", "en", None, None),
    (5, "same", "de", "b", 4),
    (7, None, "en", "a", 0),
    (8, "", "en", "a", 0),
    (None, "same", "en", "a", 4),
    (None, "only null id", "en", None, 1),
    (9, LONG, "en", "c", len(LONG)),
    (10, LONG, "en", "c", len(LONG)),
    (11, LONG + "x", "en", "c", len(LONG) + 1),
    (12, "Same", "en", "a", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


def expected_groups():
    groups = defaultdict(list)
    for row in ROWS:
        groups[row[1] or ""].append(row)
    return {text: (max((r[0] for r in rows if r[0] is not None), default=None), len(rows)) for text, rows in groups.items()}


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 500])
def test_exact_survivors(docs, table_bytes):
    got = exact_dedup.survivors(docs, table_bytes=table_bytes).collect()
    assert {(r["text"] or ""): (r["doc_id"], r["group_size"]) for r in got} == expected_groups()
    assert all(r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in got)
    whole = {row for row in ROWS}
    assert all((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) in whole for r in got)


def test_exact_assignments(docs):
    got = exact_dedup.assignments(docs).collect()
    want = expected_groups()
    digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(ROWS)
    assert all((r["keep_id"], r["group_size"]) == digest[r["text_sha256"]] for r in got)
    assert sum(r["kept"] for r in got) == len(want)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_spilling_is_recursive():
    rows = [(str(random.Random(k % 400).random()).encode() * 3, (True, k), (k,), 1) for k in range(1600)]
    got = sorted((c, k, p, n) for c, k, p, n in exact_dedup.merged(iter(rows), 3000))
    want = defaultdict(list)
    for content, key, payload, _ in rows:
        want[content].append((key, payload))
    assert got == sorted((c, max(v)[0], max(v)[1], len(v)) for c, v in want.items())


def test_table_compares_content_not_hashes():
    table = exact_dedup.ContentTable(4)
    for text in (b"a", b"b", b"a", b"c", b"d"):
        table.add(text, 12, (True, 0), (), 1)
    assert [(e[0], e[3]) for e in table.entries] == [(b"a", 2), (b"b", 1), (b"c", 1), (b"d", 1)]


def test_clashing_columns(docs):
    odd = docs.withColumn("group_size", F.lit("mine")).withColumn("text_sha256", F.lit(1)).withColumn("a`b.c", F.lit(2)).withColumn("__content", F.lit(3))
    got = exact_dedup.survivors(odd)
    assert sorted(got.columns) == sorted([*docs.columns, "a`b.c", "__content", "group_size", "text_sha256"])
    assert got.count() == len(expected_groups())


def test_empty_tables(docs):
    none = docs.limit(0)
    assert exact_dedup.survivors(none).isEmpty()
    assert exact_dedup.assignments(none).isEmpty()
    assert simhash.near_groups(none).isEmpty()
    assert simhash.representatives(none).isEmpty()
    assert mixing.replicate(none).isEmpty()


# --------------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One TWO", "a b c", "a b c d a b c", "É é x y z", LONG, "a\x0bb\x0cc\x1cd e", None])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_gray_order():
    codes = np.array([k ^ (k >> 1) for k in range(64)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(64))


def clustered(many, seed):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(5)]
    codes = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for c in centres for _ in range(many // 5)}
    return np.array(sorted(codes | {0, 1, 2**64 - 1}), np.uint64)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_tree_finds_all_pairs(most):
    codes = clustered(700, most)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    got = {pair for a, b in simhash.near_pairs(codes, most) for pair in zip(a.tolist(), b.tolist(), strict=True)}
    apart = np.bitwise_count(codes[:, None] ^ codes[None])
    assert got == {(i, j) for i, j in zip(*np.nonzero(apart <= most), strict=True) if i < j}


@pytest.mark.parametrize("leaf_rows", [4, 2048])
def test_links_connect_like_all_pairs(spark, leaf_rows):
    codes = clustered(500, 9)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    roots = components.components(simhash.links(frame, 2, leaf_rows)).collect()
    got = {r["node"]: r["root"] for r in roots}
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 2):
            parent[find(i + 1 + int(j))] = find(i)
    signed = codes.view(np.int64).tolist()
    groups = defaultdict(set)
    for i, c in enumerate(signed):
        groups[find(i)].add(c)
    found = defaultdict(set)
    for c in signed:
        found[got.get(c, c)].add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def near(one, other):
    return bin(plain_fingerprint(one[1]) ^ plain_fingerprint(other[1])).count("1") <= 2


def test_near_groups(docs):
    got = {(r["id"], r["fp"]): r["component_id"] for r in simhash.near_groups(docs).collect()}
    marks = {row: plain_fingerprint(row[1]) for row in ROWS}
    signed = {row: m - (1 << 64) if m >> 63 else m for row, m in marks.items()}
    for row in ROWS:
        linked = [r[0] for r in ROWS if near(r, row) and r[0] is not None]
        assert got[(row[0], signed[row])] == min(linked, default=None)


def test_representatives_keep_whole_rows(docs):
    rows = simhash.representatives(docs.withColumn("fp", F.lit("mine"))).collect()
    stay = {row[0] for row in ROWS if row[0] == min((r[0] for r in ROWS if near(r, row) and r[0] is not None), default=None)}
    assert {r["doc_id"] for r in rows} == stay
    assert all(r["fp"] == "mine" for r in rows)


def test_chain_of_links(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(None, 3)], "u long, v long")
    assert {r["root"] for r in components.components(chain).collect()} == {0}


# ---------------------------------------------------------------------- mixing


def test_poisson_mean_and_shares(spark):
    rows = [(k, f"t{k}", "hot" if k % 3 else f"s{k % 12}") for k in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.replicate(frame, {"hot": 1.0, "s0": 3.0}, other=1.0)
    got = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = sum({"hot": 1, "s0": 3, "s3": 1, "s6": 1, "s9": 1}.values())
    for source, n in got.items():
        want = 6000 * (3 if source == "s0" else 1) / total
        assert abs(n - want) < 6 * want**0.5
    order = [r["shuffle_key"] for r in mixed.select("shuffle_key").collect()]
    assert order == sorted(order)


def test_mixing_edges(docs):
    mixed = mixing.replicate(docs.withColumn("copy", F.lit("mine")), scale=40.0)
    rows = mixed.collect()
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert mixed.columns[-4:] == ["copy", "n_copies", "rate", "shuffle_key"]
    again = mixing.replicate(docs, scale=40.0).collect()
    assert [r["shuffle_key"] for r in rows] == [r["shuffle_key"] for r in again]
    assert mixing.replicate(docs, other=0.0).isEmpty()


@pytest.mark.parametrize("rate", [0.0, 0.3, 39.5, 300.0, 900.0, 123_456.7, 5e8])
def test_distributions_are_whole_at_any_rate(spark, rate):
    row = mixing.poisson_steps(spark.createDataFrame([("a", rate)], "__source string, rate double")).first()
    steps, first = row["steps"], row["first"]
    assert len(steps) <= 20 * rate**0.5 + 90
    assert abs(steps[-1] - 1) < 1e-9 and all(a <= b for a, b in zip(steps, steps[1:]))
    if first:
        assert steps[0] < 1e-12
    # The distribution at its mean, with the first correction of the normal law.
    at = int(rate) - first
    if rate > 30:
        middle = 0.5 * (1 + math.erf((int(rate) + 0.5 - rate) / (2 * rate) ** 0.5)) + (1 / (6 * (2 * math.pi * rate) ** 0.5))
        assert abs(steps[at] - middle) < 0.02 / rate**0.5
    mean = sum((first + k + 1) * (b - a) for k, (a, b) in enumerate(zip(steps, steps[1:]))) + first * steps[0]
    assert abs(mean - rate) < 1e-6 * max(rate, 1)


def test_a_source_of_one_row(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") == 7, "rare").otherwise("common").alias("source"))
    steps = mixing.poisson_steps(mixing.source_rates(docs))
    assert steps.agg(F.max(F.size("steps"))).first()[0] < 7000
    copies = mixing.replicate(docs).filter("source = 'rare'")
    assert abs(copies.count() - 100_000) < 6 * 100_000**0.5
