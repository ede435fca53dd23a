import math

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm.common import fold
from tillroll.llm.langid import Letters, Model, accepted, allowance, fit, identify
from tillroll.llm.queries import op7_language

GRAMS = {"x": {"  ab": 3, " aba": 2, "abab": 1, "babb": 1, "  ba": 1}, "y": {"  bc": 2, " bcb": 2, "bcbc": 3}}


def test_letters():
    to = lambda t: Letters()(t).tobytes().decode("utf-32-le")
    assert to("Ab, 12 cÉ!!") == "ab cé " and to("") == "" and to("12 ..") == "" and to("..x") == "x"


def slow_kneser_ney(grams, order, letters):
    """Interpolated Kneser-Ney by definition: p(history, letter)."""
    counts = {order: dict(grams)}
    for n in range(order - 1, 0, -1):
        counts[n] = {}
        for g in counts[n + 1]:
            counts[n][g[1:]] = counts[n].get(g[1:], 0) + 1

    def p(history, c):
        n = len(history) + 1
        ones, twos = (sum(v == k for v in counts[n].values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        own = {g: v for g, v in counts[n].items() if g[:-1] == history}
        lower = p(history[1:], c) if history else 1 / (letters + 1)
        if not own:
            return lower
        total = sum(own.values())
        return max(own.get(history + c, 0) - d, 0) / total * (history + c in own) + d * len(own) / total * lower

    return p


def test_probabilities_equal_the_definition():
    model = Model(GRAMS, 4)
    letters = {g[-1] for m in GRAMS.values() for g in m} | {c for m in GRAMS.values() for g in m for c in g[3:]}
    for lang, j in (("x", 0), ("y", 1)):
        p = slow_kneser_ney(GRAMS[lang], 4, len({c for m in GRAMS.values() for g in m for c in g[3:]}) or len(letters))
        for text in ("abab", "bcbc", "abz", "zzab", "a"):
            codes = Letters()(text)
            xent, n = model.entropies([codes])
            padded = "   " + text
            want = -sum(math.log(p(padded[i:i + 3], padded[i + 3])) for i in range(len(text))) / len(text)
            assert n[0] == len(text) and abs(xent[0, j] - want) < 1e-5, (lang, text)


def test_families_do_not_change_a_probability(monkeypatch):
    import tillroll.llm.langid as langid

    grams = {f"l{i:02}": {g: c + i for g, c in GRAMS["xy"[i % 2]].items()} for i in range(11)}
    texts = [Letters()(t) for t in ("abab", "bcbc babb", "", "zz ab")]
    apart = Model(grams, 4)
    monkeypatch.setattr(langid, "FAMILY", 100)
    together = Model(grams, 4)
    assert len(apart.families) == 2 and len(together.families) == 1
    monkeypatch.undo()
    got = apart.entropies(texts)[0]
    monkeypatch.setattr(langid, "FAMILY", 100)
    assert np.allclose(got, together.entropies(texts)[0], atol=1e-6)


def test_allowance():
    assert allowance([], 10, 100) == 10 and allowance([5, 500], 300, 400) == 300
    assert allowance([5] * 10 + [500, 500], 300, 250) == 100  # strays take only what they have
    assert allowance([500] * 4, 300, 400) == 100 and allowance([500] * 4, 300, 1200) == 300
    for have in ([3, 9, 27, 81], [50] * 7, [1000, 1]):
        share = allowance(have, 60, 100)
        assert sum(min(n, share) for n in have) <= 100


def test_hundreds_of_languages_and_null_ids(spark):
    """Each of 300 languages is learned, the common ones are not starved, and null ids are sampled row by row."""
    alphabet = [chr(0x4E00 + i) for i in range(900)]
    own = {f"l{i:03}": "".join(alphabet[3 * i:3 * i + 3]) for i in range(300)}
    rows = [(None, f"{a[0]}{a[1]} {a[2]}{a[0]} " * 12, lang) for lang, a in own.items() for _ in range(3)]
    rows += [(None, " ".join(f"word{chr(97 + i % 26)}" for i in range(n, n + 30)), "en") for n in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs, docs_per_language=500, most_grams=20_000)
    assert len(model.languages) == 301
    pred = identify(docs.join(spark.createDataFrame([(x,) for x in ("l007", "l299", "en")], "lang string"), "lang"), model)
    assert {(r["lang_pred"], r["n"]) for r in pred.groupBy("lang_pred").agg(F.count("*").alias("n")).collect()} == {
        ("l007", 3), ("l299", 3), ("en", 2000)}


def test_texts_longer_than_a_piece_are_scored_whole(monkeypatch):
    import tillroll.llm.langid as langid

    model = Model(GRAMS, 4)
    texts = [Letters()(t) for t in ("abab" * 50, "bc", "", "bcbcab " * 30)]
    want = model.entropies(texts)
    monkeypatch.setattr(langid, "PIECE", 7)
    got = model.entropies(texts)
    assert np.allclose(got[0], want[0], atol=1e-5) and (got[1] == want[1]).all()


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    labelled = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    rows = op7_language(spark, path).join(labelled, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == labelled.count() and len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)


def test_edge_rows(spark, edge_docs, no_docs, sample_docs):
    model = fit(sample_docs, train=fold(F.col("doc_id"), 4) != 2)
    rows = identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    none = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in none} == {("und", 0.0, True)}
    assert all(r["lang_pred"] in model.languages for r in rows if r["doc_id"] not in (1, 2, 3))
    kept = accepted(edge_docs, model)
    assert kept.schema == edge_docs.schema
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3})
    assert identify(no_docs, model).count() == 0 and accepted(no_docs, model).count() == 0
    untaught = fit(no_docs)
    assert {r["lang_pred"] for r in identify(edge_docs, untaught).collect()} == {"und"}
    junk = spark.createDataFrame([(1, "xqzjk wvxq zzkqj qxw jkvz " * 40)], "doc_id long, text string")
    assert identify(junk, model).first()["rejected"]
