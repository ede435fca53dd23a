import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm.decontaminate import Fingerprints, Index, contaminated, decontaminated, shingles_of, similarity, words_of
from tillroll.llm.queries import op9_decontamination


def slow_best(text, item, shingle=5):
    """Highest similarity of any window of the item's length."""
    words, wanted = words_of(text), words_of(item)
    if not words or not wanted:
        return 0.0
    k, size = min(shingle, len(wanted)), min(len(wanted), len(words))
    target = Counter(shingles_of(wanted, shingle))
    if target.keys().isdisjoint(shingles_of(words, k)):
        return 0.0
    return max(similarity(Counter(shingles_of(words[i:i + size], k)), target) for i in range(len(words) - size + 1))


def test_near_passages_against_every_window():
    rng = random.Random(0)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 50)))) for i in range(12)]
    index = Index(items, 5, 23)
    found = 0
    for _ in range(250):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        at = rng.randint(0, len(words))
        copy = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 2)):
            p = rng.choice([0, 1, len(copy) - 1, len(copy) // 2])
            copy[p:p + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 2))
        text = " ".join([*words[:at], *copy, *words[at:]])
        got = index.matches(text, 0.8)
        want = {i: s for i, t in items if (s := slow_best(text, t)) >= 0.8}
        assert {items[i][0]: round(s, 9) for i, (s, _) in got.items()} == {i: round(s, 9) for i, s in want.items()}
        found += len(want)
    assert found > 100


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.lists(st.sampled_from("abc"), max_size=8), max_size=4))
def test_short_and_repetitive_texts(words, items):
    pairs = [(i, " ".join(t)) for i, t in enumerate(items)]
    index = Index(pairs, 5, 64)
    got = index.matches(" ".join(words), 0.8)
    assert {index.items[i][0] for i in got} == {i for i, t in pairs if slow_best(" ".join(words), t) >= 0.8}


@pytest.mark.parametrize("radius", [0, 3, 15, 23])
def test_multi_index_against_all_pairs(radius, monkeypatch):
    import tillroll.llm.decontaminate as module

    rng = np.random.default_rng(radius)
    items = rng.integers(0, 2 ** 64, 40, dtype=np.uint64)
    items[5] = items[6]
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 27), replace=False)) for _ in range(300)], dtype=np.uint64)
    seen = np.concatenate([rng.choice(items, 300) ^ flips, rng.integers(0, 2 ** 64, 200, dtype=np.uint64)])
    apart = np.bitwise_count(seen[:, None] ^ items[None, :])
    want = {(int(w), int(m)) for w, m in zip(*np.nonzero(apart <= radius))}
    index = Fingerprints(items.view(np.uint8).reshape(-1, 8), radius)
    for at_once in (module.PAIRS_AT_ONCE, 7):
        monkeypatch.setattr(module, "PAIRS_AT_ONCE", at_once)
        w, m = index.within(seen.view(np.uint8).reshape(-1, 8))
        assert set(zip(w.tolist(), m.tolist())) == want and len(w) == len(want)
        assert (np.diff(apart[w, m].astype(int)) >= 0).all()
    assert Fingerprints(items[:1].view(np.uint8).reshape(-1, 8), radius).within(np.empty((0, 8), np.uint8))[0].size == 0


def test_recall_at_the_least_similarity():
    rng = random.Random(8)
    vocabulary, found, wanted = [f"w{i}" for i in range(3000)], 0, 0
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.randint(50, 200))
        copy = list(words)
        for _ in range(len(words) // 50):
            copy[rng.randrange(len(copy))] = "other"
        if slow_best(" ".join(copy), " ".join(words)) < 0.8:
            continue
        wanted += 1
        found += bool(Index([(1, " ".join(words))], 5, 15).matches("x " * 9 + " ".join(copy), 0.8))
    assert wanted > 40 and found >= 0.97 * wanted


def test_a_passage_repeated_many_times(monkeypatch):
    import tillroll.llm.decontaminate as module

    rng = random.Random(3)
    item = " ".join(rng.choices([f"w{i}" for i in range(90)], k=30))
    index = Index([(7, item)], 5, 23)
    assert index.matches("x y z " + (item + " ") * 3000, 0.8) == {0: (1.0, 3)}
    monkeypatch.setattr(module, "WINDOWS_AT_ONCE", 8)
    assert index.matches("x y z " * 20 + item + " end" * 50, 0.8) == {0: (1.0, 60)}


def test_query_finds_every_passage(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    items = {r["item_id"]: " ".join(words_of(r["text"])) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()}
    exact = {(d["doc_id"], i) for d in docs for i, t in items.items() if f" {t} " in f" {' '.join(words_of(d['text']))} "}
    rows = op9_decontamination(spark, path).collect()
    assert exact <= {(r["doc_id"], r["item_id"]) for r in rows}
    texts = {d["doc_id"]: d["text"] for d in docs}
    assert all(slow_best(texts[r["doc_id"]], items[r["item_id"]]) == r["similarity"] >= 0.8 for r in rows)


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "again in this", 0), (3, "again in this", 0), (4, "same words here again and again in this text", 0),
         (None, "a text without an id", 0)], "item_id long, text string, doc_id int")
    rows = {(r["doc_id"], r["item_id"]) for r in contaminated(edge_docs, items).collect()}
    assert rows == {(d, i) for d in (5, 6) for i in (3, 4)} | {(None, None)}
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(edge_docs, items, items_at_once=2).collect()} == rows
    kept = decontaminated(edge_docs, items)
    assert kept.schema == edge_docs.schema and sorted({r["doc_id"] for r in kept.collect()}) == [1, 2, 3, 4, 7, 8]
    assert decontaminated(edge_docs, items, items_at_once=2).count() == kept.count() == edge_docs.count() - 3
    assert contaminated(no_docs, items).count() == 0 and contaminated(edge_docs, items.limit(0)).count() == 0
    assert decontaminated(edge_docs, items.limit(0)).count() == edge_docs.count()
