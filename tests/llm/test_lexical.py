import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm.lexical import Best, Treap, descend, ranked_search, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, doc_id string"


def words(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def slow(docs, items, k=20):
    """Score every document for every item; one sorted list of (score, id) an item row."""
    terms = [(d, Counter(words(t))) for d, t, *_ in docs]
    terms = [(d, c) for d, c in terms if c]
    n_docs, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text, *_ in items:
        found = []
        for doc, c in terms:
            m = 75 + (25 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t in words(text) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, schema, items, **how):
    out = ranked_search(spark.createDataFrame(docs, schema).repartition(3), spark.createDataFrame(items, ITEMS), **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAzZ09 _-\x00\x7f\x80éÉK你\U0001f600\n\x1c "), max_size=30))
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == words(text)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 5), st.integers(1, 60), st.integers(1, 40))
def test_treap_finds_what_a_scan_finds(seed, k, n_columns, n_rows):
    rng = np.random.default_rng(seed)
    cells = np.flatnonzero(rng.random(n_columns * n_rows) < 0.3)
    if not len(cells):
        return
    columns, rows = cells % n_columns, cells // n_columns
    values = rng.integers(1, 6, len(cells)) * 10 ** rng.integers(0, 8)
    grid = np.zeros((n_rows, n_columns), dtype=np.int64)
    grid[rows, columns] = values
    asked = np.unique(rng.integers(0, n_rows + 5, 6))
    times = rng.integers(1, 4, len(asked))
    best = Best(k)
    descend(Treap(rows, columns, values), asked, times, best, np.arange(n_columns) * 3, np.zeros(n_columns, dtype=bool))
    inside = asked < n_rows
    scores = times[inside] @ grid[asked[inside]]
    plain = sorted((-s, 3 * c) for c, s in enumerate(scores.tolist()) if s > 0)[:k]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == plain


def test_sample_documents(spark, sample_docs):
    docs = [tuple(r) for r in sample_docs.collect()]
    items = [(r["item_id"], r["text"], "x") for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    expected = slow(docs, items)
    assert run(spark, docs, sample_docs.schema, items) == expected
    # Small chunks, several blocks of items, and few open ranges find the same.
    assert run(spark, docs, sample_docs.schema, items, documents_at_once=7, items_at_once=15, fan_in=2) == expected


def test_edge_rows(spark, edge_docs, no_docs):
    docs = [tuple(r) for r in edge_docs.collect()]
    items = [(1, "same words again, again", "a"), (1, "same words again, again", "a"), (2, None, "a"), (3, "", "a"), (4, "--", "a"),
             (None, "ONE text without", "a"), (5, "long Ünï 你好", "b"), (6, "unknown", "b")]
    assert run(spark, docs, edge_docs.schema, items) == slow(docs, items)
    assert run(spark, docs, edge_docs.schema, items, k=1) == slow(docs, items, 1)
    assert run(spark, [], edge_docs.schema, items) == []
    assert run(spark, docs, edge_docs.schema, []) == []


def test_a_third_are_copies(spark):
    docs = [(i, "the same passage of words" if i % 3 == 0 else f"other w{i % 17} of words w{i}", "en", "s", 1, 0) for i in range(900)]
    items = [(1, "passage of words w3 w5", "a"), (2, "the words w3 the", "a")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, item int"
    assert run(spark, docs, schema, items, documents_at_once=64) == slow(docs, items)
