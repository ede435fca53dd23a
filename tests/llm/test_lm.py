import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm.common import fold
from tillroll.llm.lm import END, Network, Symbols, _bucket_column, add_rows, bucket, looked_up, score_texts, tokens, words_of
from tillroll.llm.queries import op2_lm

WORDS = [(b"the", 50), (b"of", 30), (b"to", 20), (b"and", 10)]


def small(hidden=5, dtype=np.float64):
    symbols = Symbols(WORDS, [7, 3, 5], 8, 3)
    network = Network(symbols, hidden)
    for n, w in network.weights().items():
        setattr(network, n, w.astype(dtype))
    return symbols, network


def test_gradients_equal_finite_differences():
    symbols, network = small()
    rng = np.random.default_rng(0)
    inputs, targets = rng.integers(0, 8, (6, 3)), rng.integers(0, 8, (6, 3))
    inputs[3, 1] = END
    h = rng.standard_normal((3, 5))
    _, grads, _ = network.gradients(h, inputs, targets)
    for name, w in network.weights().items():
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(12)]:
            old = w[at]
            losses = []
            for d in (1e-5, -1e-5):
                w[at] = old + d
                losses.append(network.gradients(h, inputs, targets)[0])
            w[at] = old
            assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-6)


def test_probabilities_sum_to_one():
    symbols, network = small()
    h = np.random.default_rng(1).standard_normal((4, 5))
    total = sum(np.exp(network.output(h, np.full(4, s))) for s in range(symbols.classes * symbols.size))
    assert total == pytest.approx(np.ones(4))


def test_state_is_carried_over_windows_and_streams():
    symbols, network = small()
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 8, n), END) for n in (0, 1, 5, 40, 100, 3, 64, 31)]
    for lanes, steps in ((1, 4), (3, 7), (100, 32)):
        for doc, got in zip(docs, network.score(docs, lanes=lanes, steps=steps)):
            h, want = np.zeros((1, 5)), []
            for before, symbol in zip([END, *doc[:-1]], doc):
                h, _ = network.step(h, np.array([before]))
                want.append(network.output(h, np.array([symbol]))[0])
            assert got == pytest.approx(want, abs=1e-5)
    assert network.score([]) == []


def test_training_learns_an_order():
    symbols = Symbols([(b"a", 100), (b"b", 100), (b"c", 100)], [1], 10, 3)
    network = Network(symbols, 8)
    a, b, c = (symbols.number(w) for w in (b"a", b"b", b"c"))
    stream = np.array(([a, b, c] * 10 + [END]) * 60)
    first = network.train(stream, lanes=4, steps=16, rate=0.02)
    for _ in range(4):
        last = network.train(stream, lanes=4, steps=16, rate=0.02)
    assert last < 0.5 * first


def test_bucket_of_words_in_spark_and_python(spark):
    words = ["a", "ab", "abc", "abcdé", "ß", "你好", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = df.select(_bucket_column(F.col("w").cast("binary"), 97).alias("b")).collect()
    assert [r["b"] for r in found] == [bucket(w.encode(), 97) for w in words]


def check(rows, docs):
    """Everything but the network's score, by brute force; the scores beat the base on held-out texts."""
    train = [(d, t) for d, t in docs if crc32(str(d).encode()) % 7 != 2 or d is None]
    counts = Counter(w for _, t in train for w in tokens(t or ""))
    n, ends = sum(counts.values()) + len(train), len(train)
    v = len(counts) + (1 if train else 0)
    want = []
    for d, t in docs:
        words = tokens(t or "")
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        want.append((d, d is not None and crc32(str(d).encode()) % 7 == 2, len(words) + 1,
                     sum(w in counts for w in words) + (ends > 0), n, base))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted(([*r] for r in rows), key=key)
    assert [tuple(r[:5]) for r in got] == [w[:5] for w in sorted(want, key=key)]
    for g, w in zip(got, sorted(want, key=key)):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0
    return got


def test_query(spark, sample_docs):
    rows = op2_lm(spark, "/root/testdata/sf0.001").collect()
    check(rows, [(r["doc_id"], r["text"]) for r in sample_docs.collect()])


def test_held_out_texts_score_above_the_base(spark):
    path = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = check(op2_lm(spark, path).collect(), docs)
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])


def test_edge_rows(spark, edge_docs, no_docs):
    held = fold(F.col("doc_id"), 7) == 2
    check(score_texts(edge_docs, held).collect(), [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert score_texts(no_docs, held).count() == 0
    only = score_texts(edge_docs, F.lit(True)).collect()
    assert len(only) == edge_docs.count() and {r["train_tokens"] for r in only} == {0}


def test_copies_are_dealt_to_many_tasks(spark):
    """A third of all rows are one row: its chunk is dealt on, and every copy gets the same score."""
    rows = [(1, "the same words for all of us")] * 400 + [(i, f"word{i} and word{i * 7 % 90} again") for i in range(2, 800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = score_texts(df, F.lit(False), chunk_bytes=2000)
    found = got.collect()
    assert len(found) == len(rows)
    whole = {r["doc_id"]: r for r in score_texts(df, F.lit(False)).collect()}
    for r in found:
        assert r["n_known"] == r["n_tokens"] == whole[r["doc_id"]]["n_tokens"]
        assert r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"])
    assert len({round(r["score"], 4) for r in found if r["doc_id"] == 1}) == 1


def test_shards_are_averaged_in_steps(spark):
    from tillroll.llm.lm import _averaged

    rng = np.random.default_rng(0)
    weights = rng.standard_normal((40, 6)).astype(np.float32)
    rows = [(name, bytearray(w.tobytes()), 1 + i, i, False) for i, w in enumerate(weights) for name in ("a", "b")]
    df = spark.createDataFrame(rows, "name string, data binary, size long, shard long, summed boolean")
    out = {r["name"]: r for r in _averaged(df, 40, fan_in=3).collect()}
    want = (weights.astype(np.float64) * np.arange(1, 41)[:, None]).sum(axis=0)
    assert set(out) == {"a", "b"} and all(r["size"] == 820 for r in out.values())
    assert np.allclose(np.frombuffer(out["a"]["data"]), want)


def test_sampling_at_any_size(spark):
    """Shares far below a millionth still sample, and rows without ids are sampled one by one."""
    from tillroll.llm.common import sampled, threshold

    assert -2 ** 63 < threshold(2400 / 5e10) < threshold(1e-6) < threshold(0.5) == 0 and threshold(3.0) == 2 ** 63 - 1
    assert round((threshold(2400 / 5e10) + 2 ** 63) / 2 ** 64 * 5e10) == 2400
    same = spark.range(1_000_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'x' AS text")
    assert 9_000 < same.where(sampled(0.01, "doc_id", "text", seed=3)).count() < 11_000
    assert same.where(sampled(1.0, "doc_id", seed=3)).count() == 1_000_000


def test_every_training_token_is_learnt_once(spark, monkeypatch):
    """More documents than a sample would hold, some without an id, some repeated: all of them train the network."""
    from tillroll.llm import lm
    from tillroll.llm.common import checkpointed

    learnt, averaged = [], lm._averaged

    def counted(fitted, shards):
        fitted = checkpointed(fitted)
        learnt.append(fitted.where("name = 'U'").agg(F.sum("size").alias("n")).first()["n"])
        return averaged(fitted, shards)

    monkeypatch.setattr(lm, "_averaged", counted)
    rows = [(i % 5900 if i % 10 else None, " ".join(f"w{i * k % 300}" for k in range(1, 90))) for i in range(6000)]
    held = F.coalesce(F.col("doc_id") == 1, F.lit(False))
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), held).limit(1).first()
    assert sum(learnt) == got["train_tokens"] == 90 * 5998


def test_words_of_many_texts_at_once():
    """A batch's words are parted, numbered and looked up as one by one, without a Python call for each."""
    texts = ["", " \t the OF\x0b\x0cto\r\n", "the", "  ", "a\x1cb \x85 \u00a0Ünï 你好\x00 AND", "\u3000ß", "x" * 9 + " the"]
    symbols, _ = small()
    for kind in (pa.string(), pa.large_string()):
        for few in ([], texts[:1], texts):
            words, edges = words_of(pa.array(["not this", *few], kind).slice(1))
            found = words.to_pylist()
            assert [found[lo:hi] for lo, hi in zip(edges, edges[1:])] == [tokens(t) for t in few]
            number, rare, buckets = symbols.numbers(words)
            assert number.tolist() == [symbols.number(w) for w in found]
            assert rare.tolist() == [w not in symbols.frequent for w in found]
            assert buckets.tolist() == [bucket(w, 3) for w in found]
    keys = pa.array([b"of", b"the", b"of"])
    assert looked_up(pa.array([b"the", b"", b"of"]), keys, np.array([2.0, 1.0, 2.0]), 0).tolist() == [1, 0, 2]
    assert looked_up(pa.array([b"the"]), keys.slice(0, 0), np.array([]), 7).tolist() == [7]


def test_rows_are_added_by_place():
    rng = np.random.default_rng(0)
    for places, n in ((70, 500), (64, 1), (5, 40), (33, 0)):
        at, rows = np.sort(rng.integers(0, places, n)).astype("<u2"), rng.standard_normal((n, 6))
        total = rng.standard_normal((places, 6))
        want = total.copy()
        np.add.at(want, at, rows)
        add_rows(total, at, rows)
        assert total == pytest.approx(want)


def test_updates_are_adams():
    symbols, network = small()
    _, plain = small()
    stream = np.random.default_rng(0).integers(0, 8, 60)
    network.train(stream, lanes=2, steps=10, rate=0.02, decay_to=1.0)
    m, v = ({n: np.zeros_like(w) for n, w in plain.weights().items()} for _ in range(2))
    targets, h = stream.reshape(2, 30).T, np.zeros((2, 5))
    inputs = np.vstack([np.full((1, 2), END), targets[:-1]])
    for i, lo in enumerate((0, 10, 20), start=1):
        _, grads, h = plain.gradients(h, inputs[lo:lo + 10], targets[lo:lo + 10])
        norm = math.sqrt(sum((g * g).sum() for g in grads.values())) / 20
        for n, w in plain.weights().items():
            g = grads[n] / 20 * min(1.0, 1.0 / norm)
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.995 * v[n] + 0.005 * g * g
            w -= 0.02 * (m[n] / (1 - 0.9 ** i)) / (np.sqrt(v[n] / (1 - 0.995 ** i)) + 1e-7)
    for n, w in plain.weights().items():
        assert getattr(network, n) == pytest.approx(w, rel=1e-6, abs=1e-9)
