"""Quality field, language model, top-k search and page extraction."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import html, language_model, quality, topk

DRAW = random.Random(7)
WORDS = ["".join(DRAW.choice("abcdefgh") for _ in range(DRAW.randint(2, 7))) for _ in range(300)]


def good_text():
    return "\n".join(" ".join(DRAW.choice(WORDS) for _ in range(DRAW.randint(4, 20))) + "." for _ in range(DRAW.randint(1, 8)))


def bad_text():
    return "\n".join(" | ".join(DRAW.choice(WORDS).upper() + "!!" for _ in range(12)) for _ in range(DRAW.randint(1, 5)))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, bad_text() if k % 4 == 0 else good_text()) for k in range(400)]
    rows += [(1000, ""), (1001, None), (None, good_text()), (1002, "\n\n"), (1003, good_text() * 400), (5, rows[5][1]), (1004, "é  \x00 |")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine"))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, 0 if k % 4 == 0 else 1, 0) for k in range(300)] + [(None, 1, 0), (7, None, 0), (8, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --------------------------------------------------------------------- quality


def test_quality_separates(docs, labels):
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((got[k] < 0.5) == (k % 4 == 0) for k in range(400))
    assert all(0 <= v <= 1 for v in got.values())
    assert got[1000] == got[1001] == got[1002] == model.prior


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    """Ten ids repeated two hundred times, copies and other texts: no more rows train than asked for, and all of their lines."""
    rows = [(k % 10, f"{good_text()} {k}" if k % 2 else "same | line") for k in range(2000)]
    tags = spark.createDataFrame([(k, k % 2, 0) for k in range(10)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda matrix, values, starts, count: seen.append((len(matrix), len(count))) or None)
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), tags, sample=50)
    outside = next(k for k in range(10) if zlib.crc32(str(k).encode()) % 3 != 1)
    long = spark.createDataFrame([(outside, "a line\n" * 3000)], "doc_id long, text string")
    quality.fit(long, tags, sample=50)
    assert seen[0][1] <= 50 and seen[1][0] >= 3000


def test_quality_without_labels(docs, labels):
    model = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).isEmpty()


def test_marginals_by_enumeration():
    draw = np.random.default_rng(1)
    count = np.array([1, 4, 2])
    first = np.array([0, 1, 5])
    unary, transition = draw.normal(size=7), draw.normal(size=(2, 2))
    got, pairs = quality.marginals(unary, transition, first, count)
    want_pairs = np.zeros((2, 2))
    for low, n in zip(first, count, strict=True):
        weights, good, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(1 << n):
            path = [code >> k & 1 for k in range(n)]
            value = math.exp(sum(unary[low + k] for k in range(n) if path[k]) + sum(transition[a, b] for a, b in zip(path, path[1:], strict=False)))
            weights += value
            good += value * np.array(path)
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += value
        assert np.allclose(got[low : low + n], good / weights)
        want_pairs += moves / weights
    assert np.allclose(pairs, want_pairs)


def test_line_features_do_not_cross_documents():
    alone = [quality.line_features([t]) for t in (b"One two two\nX | y", b"", b"abc!!")]
    joined = quality.line_features([b"One two two\nX | y", b"", b"abc!!"])
    assert np.allclose(np.concatenate([a.own for a in alone]), joined.own)
    assert joined.count.tolist() == [2, 1, 1]
    both = quality.with_neighbours(joined)
    assert np.allclose(both[2], quality.with_neighbours(alone[1])[0])


# -------------------------------------------------------------- language model


def test_base_scores_and_probabilities(docs):
    got = {(r["id"], r["n_tokens"]): r for r in language_model.score(docs).collect()}
    rows = docs.collect()
    counts, texts = Counter(), []
    for r in rows:
        words = [*(r["text"] or "").encode().lower().split(), b""]
        held = zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 == 0
        texts.append((r["doc_id"], words, held))
        if not held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for doc, words, held in texts:
        row = got[(doc, len(words))]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert (row["n_known"], row["train_tokens"], row["held_out"]) == (sum(counts[w] > 0 for w in words), n, held)
        assert math.isfinite(row["score"]) and row["score"] < 0


def test_network_learns_and_carries_state():
    counts = Counter({b"": 10, b"a": 500, b"b": 500, b"c": 500})
    c = np.array([counts[w] for w in (b"", b"a", b"b", b"c")], np.float64)
    zeros = np.zeros(language_model.TAIL_CLASSES)
    vocab = language_model.Vocabulary(1510, 4, language_model.Places((w, k) for k, w in enumerate((b"", b"a", b"b", b"c"))), 4, np.arange(4, dtype=np.int32), c, c * 0, {}, zeros, zeros, c)
    net = language_model.Net(vocab)
    text = [np.array([1, 2, 3] * 40 + [0], np.int32) for _ in range(60)]
    before = language_model.log_likelihoods(net, text[:2])
    for _ in range(6):
        language_model.train(net, text)
    after = language_model.log_likelihoods(net, [*text[:2], text[0][:50]])
    assert after[0] > before[0] / 4
    # Lanes and windows don't change a document's value.
    assert np.isclose(language_model.log_likelihoods(net, text[:1])[0], after[0], rtol=1e-5)
    # Over all possible next symbols the probabilities sum to one.
    states, _ = language_model.run_states(net, np.array([[1]]), np.array([[True]]), np.zeros((1, language_model.HIDDEN), np.float32))
    symbols = np.arange(4 + language_model.TAIL_CLASSES)
    logp, _ = language_model.run_output(net, np.repeat(states[0], len(symbols), axis=0), symbols)
    assert np.isclose(np.exp(logp).sum(), 1, atol=1e-4)


def test_score_step_by_step(docs, monkeypatch):
    """Each document's score from the trained parameters, one word at a time: gates, class, word in its class, rare words."""
    kept, fit = {}, language_model.fit

    def keep(encoded, vocab, shared):
        kept["turns"] = encoded.select("held_out", "turn").collect()
        kept["vocab"], kept["flat"] = vocab, fit(encoded, vocab, shared)
        return kept["flat"]

    monkeypatch.setattr(language_model, "fit", keep)
    # Few known words and few words with an output of their own, so that many are rare.
    monkeypatch.setattr(language_model, "KNOWN_WORDS", 150)
    monkeypatch.setattr(language_model, "HEAD_WORDS", 70)
    got = {(r["id"], r["n_tokens"]): r["score"] for r in language_model.score(docs).collect()}
    vocab, h = kept["vocab"], language_model.HIDDEN
    net = language_model.Net(vocab, kept["flat"])
    p = {name: values.astype(np.float64) for name, values in net.at.items()}
    assert vocab.head == 70 and 70 < len(vocab.place) <= 151
    # Every training text is in one round.
    assert {r["turn"] for r in kept["turns"] if not r["held_out"]} == set(range(language_model.ROUNDS))
    counts = Counter()
    rows = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), b""]) for r in docs.collect()]
    for doc, words in rows:
        if zlib.crc32(b"" if doc is None else str(doc).encode()) % 10:
            counts.update(words)
    ranked = [w for w, k in vocab.place.items() if k < 70]

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    checked = rare = 0
    for doc, words in rows:
        if len(words) > 200:
            continue
        state, before, total = np.zeros(h), 0, 0.0
        for word in words:
            gates, back = p["into"][before], state @ p["back"]
            z, r = sigmoid(gates[:h] + back[:h]), sigmoid(gates[h : 2 * h] + back[h : 2 * h])
            new = np.tanh(gates[2 * h :] + r * back[2 * h :])
            state = z * state + (1 - z) * new
            classes = softmax(state @ p["classes"] + p["class_bias"])
            if word in ranked:
                symbol = vocab.place[word]
                k, at = divmod(symbol, language_model.CLASS_WORDS)
                total += math.log10(classes[k]) + math.log10(softmax(state @ p["words"][k] + p["word_bias"][k])[at])
            else:
                tail = vocab.prefix.get(word[:2], 0)
                symbol = vocab.head + tail
                others = [w for w in counts if w not in ranked and vocab.prefix.get(w[:2], 0) == tail]
                share = (counts[word] + 0.1) / (sum(counts[w] for w in others) + 0.1 * (len(others) + 1))
                total += math.log10(classes[vocab.head_classes + tail]) + math.log10(share)
                rare += 1
            before = symbol
        assert math.isclose(got[(doc, len(words))], total, rel_tol=2e-4, abs_tol=1e-3), (doc, len(words))
        checked += 1
    assert checked > 300 and rare > 1000


def test_trains_once_on_every_text(monkeypatch):
    texts = [np.array([DRAW.randrange(1, 4) for _ in range(n)] + [0], np.int16) for n in [0, 1, 3, 5, 5, 127, 128, 300, 4000] * 3]
    c, zeros = np.array([27.0, 9, 9, 9]), np.zeros(language_model.TAIL_CLASSES)
    vocab = language_model.Vocabulary(54, 4, language_model.Places(), 4, np.arange(4, dtype=np.int32), c, c * 0, {}, zeros, zeros, c)
    seen = []
    monkeypatch.setattr(language_model, "train", lambda net, texts: seen.extend(tuple(t.tolist()) for t in texts) or sum(map(len, texts)))
    monkeypatch.setattr(language_model, "_CHUNK_TOKENS", 200)
    shared, flat = type("Shared", (), {"value": vocab}), language_model.Net(vocab).flat
    batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts[low : low + 4]], pa.binary())], ["symbols"]) for low in range(0, len(texts), 4)]
    (out,) = language_model._trainer(shared, flat)(iter(batches))
    assert sorted(seen) == sorted(tuple(t.tolist()) for t in texts) and out.column(1)[0].as_py() == sum(map(len, texts))


def test_windows_keep_texts_whole():
    texts = [np.arange(1, n + 1, dtype=np.int32) for n in (1, 2, 31, 32, 33, 64, 200)]
    got = {k: [] for k in range(len(texts))}
    for x, target, valid, fresh, owner in language_model.windows(texts, 3, 0):
        for lane in range(x.shape[1]):
            for t in np.flatnonzero(valid[:, lane]):
                got[owner[t, lane]].append((x[t, lane], target[t, lane], fresh[t, lane]))
    assert got == {k: [(n - 1, n, n == 1) for n in range(1, len(text) + 1)] for k, text in enumerate(texts)}


def test_gradients_by_differences():
    draw = np.random.default_rng(2)
    c = np.array([3.0, 5, 7, 2, 9])
    zeros = np.zeros(language_model.TAIL_CLASSES)
    vocab = language_model.Vocabulary(26, 5, {}, 5, np.arange(5, dtype=np.int32), c, c, {}, zeros, zeros, c)
    net = language_model.Net(vocab)
    net.flat = net.flat.astype(np.float64)
    shapes = {name: values.shape for name, values in net.at.items()}
    low = 0
    for name, shape in shapes.items():
        net.at[name] = net.flat[low : low + int(np.prod(shape))].reshape(shape)
        low += int(np.prod(shape))
    x, target = draw.integers(0, 6, (5, 3)), draw.integers(0, 6, (5, 3))
    valid, fresh = draw.random((5, 3)) < 0.8, draw.random((5, 3)) < 0.3
    grad, _, _ = language_model.gradients(net, x, target, valid, fresh, np.zeros((3, language_model.HIDDEN)))

    def value():
        states, _ = language_model.run_states(net, x, fresh, np.zeros((3, language_model.HIDDEN)))
        real = np.flatnonzero(valid.ravel())
        return language_model.run_output(net, states.reshape(-1, language_model.HIDDEN)[real].astype(np.float64), target.ravel()[real])[0].mean()

    for at in draw.choice(np.flatnonzero(np.abs(grad.flat) > 1e-4), 25, replace=False):
        kept, step = net.flat[at], 1e-2
        net.flat[at] = kept + step
        up = value()
        net.flat[at] = kept - step
        down = value()
        net.flat[at] = kept
        assert np.isclose((up - down) / (2 * step), grad.flat[at], rtol=0.05, atol=2e-4)


def test_scores_of_empty_tables(docs):
    assert language_model.score(docs.limit(0)).isEmpty()
    only = docs.filter(language_model.held_out())
    assert {r["n_known"] for r in language_model.score(only).collect()} == {0}


# ---------------------------------------------------------------------- search


def test_top_k_by_brute_force(spark):
    draw = random.Random(3)
    rows = [(k, [float(draw.randint(-3, 3)) / 7 for _ in range(4)]) for k in range(600)]
    rows += [(1000, None), (1001, [1.0, None, 1.0, 1.0]), (1002, [float("nan")] * 4), (1003, [float("inf"), 0.0, 0.0, 0.0]), (1050, [])]
    rows += [(None, [9.0, 9.0, 9.0, 9.0]), (1100, [0.5, 0.5]), (1150, [0.25, 1.0]), (50, [1.0, 1.0, 1.0, 1.0]), (1200, [1e30, -1e30, 1.0, 3e5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("mine")).repartition(5)
    got = topk.top_k(frame, frame.filter("vec_id % 50 = 0")).collect()
    fine = [(k, [math.floor(256 * x) for x in v]) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for key, query in fine:
        if key is None or key % 50:
            continue
        limit = 2**63
        scored = [(min(max(sum(a * b for a, b in zip(query, v, strict=True)), -limit), limit - 1), k) for k, v in fine if k != key and len(v) == len(query)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        want += [(key, rank, k, score) for rank, (score, k) in enumerate(scored[:5], 1)]
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr) == sorted(want, key=repr)


def test_top_k_of_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, none).isEmpty()


# ------------------------------------------------------------------------ html

PAGE = (
    "<html><head><title>no</title><style>p{}</style></head><body><nav><a href=/>menu</a></nav><div class='ad top-3'>buy</div>"
    "<div class='post-12 main'><h1>Head &amp; more</h1><p>First <b>bo</b>ld\n\t line<br>next<p>second&nbsp;one &#x41;<script>if (a<b) x()</script>"
    "<ul><li>item<li>other</ul><div class=share-bar>share</div></div><div id='comments'><p>a very long reader comment, longer than the article is, "
    "and again a very long reader comment, longer than all</div><footer>&copy; foot</footer></body></html>"
)
TEXT = "Head & more First bold line next second one A item other"


def test_extracts_article():
    assert html.extract(html.parse(PAGE), None) == TEXT
    assert html.extract(html.parse(PAGE), ">html>body>div.main.post") == TEXT


@pytest.mark.parametrize("text", ["", "<", "<<>>", "<p", "a < b", "<!-- open", "<script>x", "</div></div>", "<div " * 50, "&#xffffffff;&bogus;", "<a href='x>y'>z"])
def test_broken_pages_do_not_fail(text):
    assert isinstance(html.extract(html.parse(text), "x"), str)


LONG = "a paragraph of the article that goes on for quite a while and then some more"


@pytest.mark.parametrize(
    "body",
    [
        f"<article><h1>Head</h1><p>lead</p><section><p>{LONG}</section><section><p>{LONG}</section></article>",
        f"<article><h1>Head</h1><p>lead</p><div><section><p>{LONG}</section><section><p>{LONG}</section></div></article>",
        f"<div class=post><div class=lead><h1>Head</h1>lead</div><div class=body><p>{LONG}<p>{LONG}</div></div><div class=tags><a href=/>x</a></div>",
        f"<div class='content has-sidebar'><h1>Head</h1>lead<p>{LONG}<p>{LONG}</div><div class='sidebar'>{LONG}</div>",
        f"<div class='no-sidebar'><h1>Head</h1><p>lead<p>{LONG}<p>{LONG}</div><div class='related-posts'>{LONG}</div>",
    ],
)
def test_keeps_nested_articles_whole(body):
    page = html.parse(f"<html><body><nav><a href=/>menu</a></nav>{body}<footer>foot</footer></body></html>")
    want = f"Head lead {LONG} {LONG}"
    best = html.votes(page)
    assert html.extract(page, None) == want
    assert html.extract(page, max(best, key=lambda p: (best[p], len(p), p))) == want


def test_lead_beside_body_under_the_page_body():
    page = html.parse(f"<html><body><div class=lead>{LONG}</div><div class=body><p>{LONG}<p>{LONG}</div></body></html>")
    assert html.extract(page, None) == f"{LONG} {LONG} {LONG}"


def test_hosts_agree(spark):
    rows = [(k, f"http://Host.example/{k}", PAGE) for k in range(5)]
    # Alone, this page's best container would be another one.
    odd = "<body><div class='post-9 main'><p>short</div><section><p>a longer text that is not the article on this host</section></body>"
    rows += [(9, "https://u@host.example:80/odd", f"<html>{odd}</html>"), (10, None, odd), (11, "nonsense", PAGE), (12, "http://host.example", None), (12, "http://host.example", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    got = html.main_text(pages).collect()
    by_id = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [by_id[k] for k in range(5)] == [TEXT] * 5
    assert (by_id[9], by_id[11], by_id[12]) == ("short", TEXT, "")
    assert by_id[10] == "a longer text that is not the article on this host"
    assert html.main_text(pages.limit(0)).isEmpty()


def test_scored_texts_travel_once_and_a_few_at_a_time(spark):
    width = 3 * len(quality._NAMES) + 3
    model = quality.Model(np.zeros(width), np.ones(width), np.linspace(-1, 1, width), np.zeros((2, 2)), 0.25)
    texts = ["Some words here.\nAnd more | of them", None, "", "é" * 50, "a" * 1_100_000, "b c " * 200_000]
    want = quality.score_texts(model, [(text or "").encode() for text in texts])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    scored = quality.score(df, model)
    assert "__text" not in scored._jdf.queryExecution().analyzed().toString()
    got = {r["doc_id"]: (r["text"], r["score"]) for r in scored.collect()}
    assert got == {i: (text, pytest.approx(want[i])) for i, text in enumerate(texts)}
    assert [r["score"] for r in quality.score(df.selectExpr("cast(7 as int) text").limit(1), model).collect()] == pytest.approx(quality.score_texts(model, [b"7"]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["__0", "__1"])
    assert [part.num_rows for part in quality._scorer(model, 1, 2)(iter([batch]))] == [5, 1]
