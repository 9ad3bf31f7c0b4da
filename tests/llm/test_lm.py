import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from logweave.llm import lm as L


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts, model = L.fit(docs)
    return docs, counts, model


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_counts_base_and_unknown_tokens(fitted):
    docs, counts, model = fitted
    rows = docs.collect()
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(t for r in rows if not out(r.doc_id) for t in tokens(r.text))
    total, distinct = sum(c.values()), len(c)
    text = {r.doc_id: r.text for r in rows}
    for r in L.score_documents(docs, counts, model).collect():
        words = tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out(r.doc_id), len(words), total)
        assert r.n_known == sum(c[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in words))


def after(model, reader, history):
    """history -> (class probabilities, unit probabilities of every class) of the next token."""
    symbols = np.concatenate([np.full(L.HISTORY, reader.gap), reader.symbols(history)])[:-1]
    place = np.full(L.CLASSES, len(symbols))
    classes = np.arange(L.CLASSES)
    p = np.exp(L.log_probabilities(model, model.weights, L.features(np.append(symbols, 0), place, classes), classes).astype(float))
    return p[0], p[L.CLASSES:]


def probability(model, c, p_class, p_unit, w):
    if w in model.head:
        i = model.head[w]
        k, unit = divmod(int(model.head_unit[i]), L.WIDTH)
        return p_class[k] * p_unit[k, unit] * 10 ** model.log_share[i]
    bucket = L.ending_bucket(w)
    k, unit = divmod(L.shared_unit(bucket, True), L.WIDTH)
    known = c[w] - model.discount if w in c else 10 ** model.log_unknown[bucket]
    return p_class[k] * p_unit[k, unit] * known / 10 ** model.log_tail_total[bucket]


def test_score_is_the_models_probability_and_sums_to_one(fitted, monkeypatch):
    docs, counts, model = fitted
    c = {r.token.encode(): r.c for r in counts.collect()}
    reader = L.Reader(model)
    row = min((r for r in docs.collect() if len(tokens(r.text)) > 15), key=lambda r: len(r.text))
    words = tokens(row.text)
    want = sum(math.log10(probability(model, c, *after(model, reader, words[:i]), w)) for i, w in enumerate(words))
    got = next(r for r in L.score_documents(docs, counts, model).collect() if r.doc_id == row.doc_id)
    assert got.score == pytest.approx(want, rel=1e-4)
    p_class, p_unit = after(model, reader, words[:5])
    mass = sum(probability(model, c, p_class, p_unit, w) for w in c)
    for bucket in range(L.BUCKETS):
        k, unit = divmod(L.shared_unit(bucket, True), L.WIDTH)
        mass += p_class[k] * p_unit[k, unit] * 10 ** (model.log_unknown[bucket] - model.log_tail_total[bucket])
    # units without any token keep the little mass of their prior
    used = set(model.head_unit.tolist()) | {L.shared_unit(b, True) for b in range(L.BUCKETS)}
    mass += sum(p_class[u // L.WIDTH] * p_unit[u // L.WIDTH, u % L.WIDTH] for u in range(L.CLASSES * L.WIDTH) if u not in used)
    assert mass == pytest.approx(1.0, abs=1e-4)
    assert len(model.head) + sum(model.tail_words) == len(c)


def test_a_text_of_many_chunks_scores_like_the_model_token_by_token(spark, fitted, monkeypatch):
    docs, counts, model = fitted
    monkeypatch.setattr(L, "CHUNK", 16)
    c = {r.token.encode(): r.c for r in counts.collect()}
    reader = L.Reader(model)
    text = " ".join(w for r in docs.limit(5).collect() for w in (r.text or "").split()[:40])
    words = tokens(text)
    assert len(words) > 100
    want = sum(math.log10(probability(model, c, *after(model, reader, words[:i]), w)) for i, w in enumerate(words))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    shared = type("Shared", (), {"value": model})
    parts = [r for b in L._score(iter([batch]), shared) for r in b.to_pylist()]
    tail = sum(r["tf"] * (math.log10(c[r["token"].encode()] - model.discount) if r["token"].encode() in c else r["unknown"]) for r in parts if r["tf"])
    assert sum(r["score"] for r in parts if r["score"] is not None) + tail == pytest.approx(want, rel=1e-4)


def test_context_changes_the_order_of_two_words_of_one_class(spark):
    rows = [(i, "red apple . blue apricot . " * 30) for i in range(40)]
    counts, model = L.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    reader, c = L.Reader(model), {r.token.encode(): r.c for r in counts.collect()}
    one, two = (int(model.head_unit[model.head[w]]) for w in (b"apple", b"apricot"))
    assert one // L.WIDTH == two // L.WIDTH and one != two
    red, blue = (after(model, reader, history) for history in ([b"apricot", b".", b"red"], [b"apple", b".", b"blue"]))
    assert probability(model, c, *red, b"apple") > probability(model, c, *red, b"apricot")
    assert probability(model, c, *blue, b"apple") < probability(model, c, *blue, b"apricot")


def test_tail_goes_through_the_join(fitted, monkeypatch, spark):
    docs, counts, _ = fitted
    monkeypatch.setattr(L, "HEAD", 50)
    small = L.fit_head(counts)
    assert len(small.head) == 50
    a = {r.doc_id: r for r in L.score_documents(docs, counts, small).collect()}
    monkeypatch.setattr(L, "HEAD", 1 << 16)
    for r in L.score_documents(docs, counts, L.fit_head(counts)).collect():
        assert (r.n_known, r.n_tokens) == (a[r.doc_id].n_known, a[r.doc_id].n_tokens)
        assert r.base_score == pytest.approx(a[r.doc_id].base_score)


def test_better_than_the_base_on_held_out_text(spark):
    rows = [r for r in L.op2_lm_score(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.3


def test_gradient_updates_lower_the_loss(fitted):
    docs, counts, model = fitted
    plain = L.fit_head(counts)
    before = sum(r.score for r in L.score_documents(docs, counts, plain).collect())
    after = sum(r.score for r in L.score_documents(docs, counts, model).collect())
    assert after > before


def test_odd_rows(spark, docs, empty):
    counts, model = L.fit(docs)
    rows = L.score_documents(docs, counts, model).collect()
    assert len(rows) == docs.count() and all(math.isfinite(r.score) for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (9001, 9002, 9003))
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert sum(r.doc_id == 9009 for r in rows) == 3
    none, blank = L.fit(empty)
    got = L.score_documents(docs, none, blank).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert L.score_documents(empty, counts, model).count() == 0


def test_a_feature_for_each_of_the_three_tokens_back(fitted):
    model = fitted[2]
    assert model.weights.shape == (2 * L.ROWS, 64) and model.weights.dtype == np.float32
    a, b = (L.features(np.array([x, 3, 2, 0]), np.array([3]), np.array([5])) for x in (7, 8))
    assert a[:-1].tolist() == b[:-1].tolist() and (a[-1] != b[-1]).all()
    other = L.features(np.array([7, 3, 2, 0]), np.array([3]), np.array([6]))
    assert (a[:, 0] == other[:, 0]).all() and (a[:, 1] != other[:, 1]).all() and (a[:, 1] >= L.ROWS).all()


TEXTS = [None, "", " \t", "The the THE end", "Été été x Z", "  a b\nc　d e\x1cf \x85g ", "word " * 700, "中 ß \U0001f600 q"]


def test_words_are_read_by_distinct_word_as_one_by_one(fitted, monkeypatch):
    model = fitted[2]
    reader, raw = L.Reader(model), [(t or "").encode() for t in TEXTS]
    one = lambda w: model.head.get(w, len(model.head) + L.ending_bucket(w))
    want = [[one(w) for w in t.lower().split() + [L.END]] for t in raw]
    assert [s.tolist() for s in reader.documents(raw)] == want
    assert [reader.symbols(t.lower().split()).tolist() for t in raw] == want
    monkeypatch.setattr(L, "SLICE", 8)
    assert [s.tolist() for s in reader.documents(raw)] == want
    assert [s.tolist() for s in reader.documents([b"", b" "])] == [[one(L.END)]] * 2 and list(reader.documents([])) == []
    for flush in (3, 10 ** 6):
        monkeypatch.setattr(L, "FLUSH", flush)
        got = Counter()
        for b in L._counts(iter([pa.RecordBatch.from_pydict({"text": TEXTS})])):
            got.update({r["token"].encode(): r["c"] for r in b.to_pylist() if r["c"]})
        assert got == Counter(t for x in TEXTS for t in tokens(x))


def test_sums_of_rows_by_key():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(5000, L.WIDTH)).astype(np.float32)
    keys = np.sort(np.r_[np.zeros(4000, np.int64), np.full(L.FAN + 1, 7), rng.integers(9, 3000, 9000)])
    places = rng.integers(0, len(values), len(keys))
    want, got = np.zeros((3001, L.WIDTH)), np.ones((3001, L.WIDTH), np.float32)
    np.add.at(want, keys, values[places].astype(np.float64))
    L.sums_by_key(values, places, keys, got)
    assert np.abs(got - want).max() < 1e-3 and (got[8] == 0).all()
    L.sums_by_key(values, places[:0], keys[:0], got)
    assert not got.any()


def test_large_weights_stay_finite_and_logits_are_held_in_blocks(fitted):
    model, rng = fitted[2], np.random.default_rng(2)
    n = 3 * L.HELD // 2
    symbols, classes, units = rng.integers(0, 500, n + 3), rng.integers(0, 64, n), rng.integers(0, 64, n)
    rows = L.features(symbols, np.arange(3, n + 3), classes)
    for scale in (0.1, 100):
        weights = (rng.normal(size=model.weights.shape) * scale).astype(np.float32)
        logits = np.concatenate([np.broadcast_to(model.class_bias, (n, 64)), model.unit_bias[classes]]).astype(np.float64)
        logits += sum(weights[r].astype(np.float64) for r in rows)
        top = logits.max(axis=1, keepdims=True)
        log_p = (logits - top) - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
        own = log_p[np.arange(2 * n), np.r_[classes, units]]
        got = L.target_log_probability(model, weights, rows, classes, units)
        assert np.abs(got - (own[:n] + own[n:])).max() < 1e-4 * max(1, scale)
        assert np.abs(L.log_probabilities(model, weights, rows, classes) - log_p).max() < 1e-4 * max(1, scale)
        assert np.isfinite(L._errors(model, weights, rows, classes, units)).all()
    assert max(len(x) for _, x in L._logits(model, weights, rows, classes)) == L.HELD


def drawn(model, scale, n=3 * L.HELD // 2):
    rng = np.random.default_rng(3)
    symbols, classes, units = rng.integers(0, 500, n + 3), rng.integers(0, 64, n), rng.integers(0, 64, n)
    weights = (rng.normal(size=model.weights.shape) * scale).astype(np.float32)
    return weights, L.features(symbols, np.arange(3, n + 3), classes), classes, units


def test_scoring_takes_no_exponentials_for_each_token(fitted, monkeypatch):
    model, taken, exp = fitted[2], [], np.exp
    monkeypatch.setattr(L.np, "exp", lambda x, **k: (taken.append(np.size(x)), exp(x, **k))[1])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words of a text " * 20_000]})
    assert list(L._score(iter([batch]), type("Shared", (), {"value": model})))
    assert sum(taken) <= model.weights.size + (L.CLASSES + 1) * L.WIDTH < 100_000 * 2 * L.WIDTH


def test_products_of_exponentials_are_the_exponentials_of_sums(fitted):
    model = fitted[2]
    for scale, fit in ((0.1, True), (2.0, True), (4.0, False), (100, False)):
        weights, rows, classes, units = drawn(model, scale)
        powers = L.Powers(model, weights)
        assert powers.fit(len(rows)) == fit
        got, want = (L.target_log_probability(model, weights, rows, classes, units, p) for p in (powers, None))
        assert np.isfinite(got).all() and np.abs(got - want).max() < 1e-5 * max(1, scale)
        want, n = L._errors(model, weights, rows, classes, units), len(classes)
        for part in slice(0, n), slice(n, 2 * n):
            got = L._errors(model, weights, rows, classes, units, powers, np.empty((4 * n, L.WIDTH), np.float32), part)
            assert np.abs(got - want[part]).max() < 1e-5


def test_a_bound_of_the_weights_is_replaced_by_the_weights_themselves(fitted):
    model = fitted[2]
    powers = L.Powers(model, np.full_like(model.weights, -3))
    powers.reach = 1000.0
    assert powers.fit(4) and powers.reach == 3
    powers.weights[5, 5] = 20
    powers.reach = 20.0
    assert not powers.fit(4)


def test_training_is_gradient_steps_of_all_tokens(fitted, monkeypatch):
    model = L.fit_head(fitted[1])
    model.weights[:] = np.random.default_rng(4).normal(size=model.weights.shape) / 4
    monkeypatch.setattr(L, "STEP", 64)
    texts = ["the cat sat on the mat and the dog sat on the cat " * 3, "", None, "one two three two one " * 30]
    reader = L.Reader(model)
    weights, squares, met = model.weights.astype(np.float64), np.ones(model.weights.shape), np.zeros(2 * L.ROWS, int)
    for symbols, place, _ in L.chunks(reader.documents([(t or "").encode() for t in texts]), reader.gap, L.STEP):
        classes, units = reader.targets(symbols[place])
        rows = L.features(symbols, place, classes)
        logits = np.concatenate([np.broadcast_to(model.class_bias, (len(classes), 64)), model.unit_bias[classes]]) + weights[rows].sum(axis=0)
        error = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        error[np.arange(len(error)), np.r_[classes, units]] -= 1
        gradient = np.zeros(weights.shape)
        for r in rows:
            np.add.at(gradient, r, error)
            np.add.at(met, r, 1)
        squares += gradient ** 2
        weights -= 0.5 * gradient / np.sqrt(squares)
    start, got, times = model.weights.copy(), np.zeros(weights.shape), np.zeros(2 * L.ROWS, int)
    batch = pa.RecordBatch.from_pydict({"text": texts})
    for b in L._train(iter([batch]), type("Shared", (), {"value": model}), 0.5):
        for r in b.to_pylist():
            got[r["block"]:r["block"] + L.BLOCK] = np.frombuffer(r["change"], np.float32).reshape(L.BLOCK, -1)
            times[r["block"]:r["block"] + L.BLOCK] = np.frombuffer(r["met"], np.int64)
    assert (times == met).all() and met.sum() > 1000 and (model.weights == start).all()
    assert np.abs(got - (weights - start)).max() < 1e-5
