import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tillroll.llm.common import connected_components
from tillroll.llm.queries import op4_simhash
from tillroll.llm.simhash import fingerprint, near_duplicates, near_pairs, one_per_component


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """doc_id -> smallest reachable, over all pairs."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, fa) in enumerate(prints):
        for b, fb in prints[:i]:
            if (fa ^ fb).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d, _ in prints}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB éÉ\t\n\x0b\x1c\xa0", max_size=40))
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_query_equals_brute_force(spark, sample_docs):
    docs = [(r["doc_id"], r["text"]) for r in sample_docs.collect()]
    prints = [(d, slow_fingerprint(t)) for d, t in docs]
    roots = slow_components(prints)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op4_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert found == {d: (f"{f:016x}", roots[d]) for d, f in prints}


def test_all_pairs_within_the_radius(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    prints = {int(x) for x in base} | {0, 2**64 - 1}
    for x in base.tolist():
        for n in range(1, 5):
            prints.add(x ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    prints = sorted(prints)
    rows = [(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(prints)]
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints))
            if (prints[i] ^ prints[j]).bit_count() <= 3}
    classes = spark.createDataFrame(rows, "rep long, fp long")
    for segments in (2, 3, 4):
        assert {tuple(r) for r in near_pairs(classes, radius=3, segments=segments).collect()} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}


def test_edge_rows(edge_docs, no_docs):
    rows = near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    of = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert of[1]["fingerprint"] == of[3]["fingerprint"] == "0" * 16
    assert of[1]["component_id"] == of[2]["component_id"] == of[3]["component_id"] == 1
    assert of[6]["component_id"] == 5
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert near_duplicates(no_docs).count() == 0


def test_one_document_of_each_component(edge_docs, no_docs):
    kept = one_per_component(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 7, 8] and ids.count(None) == 1
    assert one_per_component(no_docs).count() == 0
    assert one_per_component(edge_docs.where(F.col("doc_id") > 4)).count() == 3
