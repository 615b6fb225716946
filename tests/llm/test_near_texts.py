"""Near-duplicate groups at five words and 0.8 against brute force, and what the pipeline keeps."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import near_texts

SCHEMA = "doc_id long, text string"


def sets(text, words=5):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, 1))) if found else frozenset()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def variants(seed, families=40):
    """Texts, each with copies that have a few words changed: pairs of all similarities."""
    draw = random.Random(seed)
    rows = []
    for family in range(families):
        words = [f"w{draw.randrange(2000)}" for _ in range(draw.randint(40, 300))]
        rows.append(" ".join(words))
        for _ in range(4):
            changed = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 60))):
                changed[draw.randrange(len(changed))] = f"x{draw.randrange(10**6)}"
            rows.append(" ".join(changed))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def found(spark):
    rows = variants(3)
    groups = {r["id"]: r["component_id"] for r in near_texts.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    return rows, groups


def test_recall_and_precision_against_brute_force(found):
    rows, groups = found
    shingles = {k: sets(t) for k, t in rows}
    pairs = [(a, b, similarity(shingles[a], shingles[b])) for a in shingles for b in shingles if a < b]
    near = [(a, b) for a, b, s in pairs if s >= 0.8]
    far = [(a, b) for a, b, s in pairs if s < 0.5]
    assert len(near) > 150
    assert sum(groups[a] == groups[b] for a, b in near) >= 0.9 * len(near)
    assert not any(groups[a] == groups[b] for a, b in far)
    # Groups are those of true links alone.
    link = defaultdict(set)
    for a, b in near:
        link[a].add(b)
        link[b].add(a)
    for k in shingles:
        seen, todo = {k}, [k]
        while todo:
            for n in link[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        assert groups[k] in seen


def test_edges_of_the_input(spark):
    text = " ".join(f"v{k}" for k in range(100))
    rows = [(5, text), (5, text), (2, text.upper()), (9, None), (8, ""), (7, " \n"), (None, text), (None, "alone in here"), (3, "one"), (4, "one two"), (6, "ONE"), (1, "x" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("a"), "cls": F.lit(1), "fp": F.lit(2), "component_id": F.lit(3)})
    groups = sorted(((r["id"], r["component_id"]) for r in near_texts.near_groups(df).collect()), key=repr)
    assert groups == sorted([(5, 2), (5, 2), (2, 2), (9, 7), (8, 7), (7, 7), (None, 2), (None, None), (3, 3), (4, 4), (6, 3), (1, 1)], key=repr)
    kept = near_texts.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.filter("doc_id is not null").collect()) == sorted([(2, text.upper()), (7, " \n"), (3, "one"), (4, "one two"), (1, "x" * 300_000)])
    assert [r["text"] for r in kept.filter("doc_id is null").collect()] == ["alone in here"]
    assert near_texts.near_groups(df.limit(0)).count() == 0


def test_a_large_group_makes_few_links(spark):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(400):
        changed = list(words)
        changed[draw.randrange(200)] = f"z{k}"
        rows.append((k, " ".join(changed)))
    groups = near_texts.near_groups(spark.createDataFrame(rows, SCHEMA), leaf_rows=16).collect()
    assert {r["component_id"] for r in groups} == {0}


CLASHES = ["score", "group_size", "text_sha256", "copy", "rate", "n_copies", "shuffle_key", "id", "cls", "component_id", "__gone", "__hash", "__text"]


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stages_keep_every_column(spark, data, name, stage):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    odd = docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string")})
    docs = docs.unionByName(odd).unionByName(docs.limit(3)).withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHES})
    made = stage(spark, docs, data)
    assert made.dtypes == docs.dtypes
    rows = made.collect()
    assert rows and all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHES)
    empty = stage(spark, docs.limit(0), data)
    assert empty.dtypes == docs.dtypes and empty.count() == 0


def test_packing_of_odd_rows(spark, data):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2, "words " * 5000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    pieces = corpus_pipeline.pack_sequences(spark, docs, data).collect()
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in pieces if r["doc_id"] is not None and r["doc_tokens"] == 1) == [(1, 1), (1, 1)]
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), data).count() == 0
