from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm.common import fold
from tillroll.llm.queries import op8_toxicity
from tillroll.llm.toxicity import BOUNDARY, Spelling, clean_words, core_of, fit, lattice, restore, score_toxicity, spelled_out


def spelling(words):
    grams = Counter()
    for w, n in words.items():
        s = BOUNDARY * 2 + w + BOUNDARY
        for i in range(len(s) - 2):
            grams[s[i:i + 3]] += n
    return Spelling(grams)


MODEL = spelling({"idiot": 30, "stupid": 30, "moron": 20, "trash": 20, "house": 50, "water": 50, "letter": 40, "street": 40})


def test_viterbi_finds_the_best_path():
    for word in ("1d10t", "$tup!d", "m0r0n", "sttupid", "tr@sh", "s.t", "h0use", "tt3r"):
        def value(path):
            letters = "".join(x for x, _ in path)
            padded = BOUNDARY * 2 + letters + BOUNDARY
            return sum(c for _, c in path) + sum(MODEL.logp(padded[i:i + 2], padded[i + 2]) for i in range(len(letters) + 1))

        best = max(product(*lattice(word)), key=value)
        got = restore(word, MODEL)
        want = "".join(x for x, _ in best)
        assert got == want, word


@pytest.mark.parametrize("token,word", [
    ("1d10t", "idiot"), ("stup1d", "stupid"), ("$tupid", "stupid"), ("m0r0n", "moron"), ("stuuuupid", "stupid"),
    ("i.d.i.o.t", "idiot"), ("tr@sh!!", "trash"), ("st*pid", "stupid"), ("s-t-u-p-i-d", "stupid"), ("house$$$", "house")])
def test_distorted_words_are_restored(token, word):
    assert word in clean_words(token, MODEL)


def test_clean_tokens_stay():
    assert clean_words("water,", MODEL) == ("water",) and clean_words("letter", MODEL) == ("letter",)
    assert clean_words("1234", MODEL) == () and clean_words("***", MODEL) == ()
    assert clean_words("house-water", MODEL) == ("house", "water")
    assert "stupid" in spelled_out("he is s t u p i d now".split())


def test_edges_of_tokens():
    for token, core in (("(word),", "word"), ("word$$$", "word"), ("###word%%%", "word"), ("$tupid!!", "$tupid"), ("---", ""),
                        ("a" + "-" * 5000 + "b", "a" + "-" * 5000 + "b"), ("", ""), ("_x_", "_x_")):
        assert core_of(token) == core


def test_odd_long_tokens_end_soon():
    for token in ("x" + "-" * 20_000 + "y", "a*" * 5_000 + "b", "a**" * 2_000 + "b", ".,;" * 20_000, "1" * 20_000 + "a"):
        assert isinstance(clean_words(token, MODEL), tuple)


def measure(rows):
    y = np.array([r["toxic"] for r in rows])
    s, p = np.array([r["score"] for r in rows]), np.array([r["predicted"] for r in rows])
    ranks = s.argsort(kind="stable").argsort(kind="stable")
    area = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    return area, p[y == 1].mean(), p[y == 0].mean()


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = op8_toxicity(spark, path)
    area, caught, wrong = measure(rows.where("held_out").join(labels, "doc_id").collect())
    assert area > 0.95 and caught > 0.8 and wrong < 0.02


def test_edge_rows(spark, edge_docs, no_docs, sample_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scorer = fit(sample_docs, labels, train=fold(F.col("doc_id"), 4) != 2)
    rows = score_toxicity(edge_docs, scorer).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert score_toxicity(no_docs, scorer).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(edge_docs, fit(sample_docs, nulls)).collect()} == {0.0}
    assert score_toxicity(edge_docs, fit(edge_docs, nulls.limit(0))).count() == edge_docs.count()


@pytest.mark.parametrize("word", ["st**id", "s***id", "**iot", "i**0t", "tr**h", "m*r*n", "h**se", "#t?p", "é**t", "ab*cé*"])
def test_wildcards_are_decoded_exactly(word):
    """Every path of the lattice, whatever number of states the wildcards reach."""
    columns = lattice(word)
    best, got = {"": 0.0}, restore(word, MODEL)
    for column in columns:  # all distinct strings, none dropped
        new = {}
        for letters, score in best.items():
            padded = BOUNDARY * 2 + letters
            for x, cost in column:
                now = score + cost + (MODEL.logp(padded[-2:], x) if x else 0.0)
                new[letters + x] = max(now, new.get(letters + x, -1e9))
        best = new
    ends = {w: s + MODEL.logp((BOUNDARY * 2 + w)[-2:], BOUNDARY) for w, s in best.items()}
    assert ends[got] == pytest.approx(max(ends.values()), abs=1e-9)


def test_long_runs_of_wildcards_end_soon():
    assert isinstance(restore("a" + "*" * 5000 + "é", MODEL), str)


def test_every_labelled_document_teaches(spark):
    """A sign in 18 of 26,000 labelled documents, too few for a sample of them to hold, is learnt."""
    rows = [(i, f"water house {i % 97} zorgle" if i % 1500 == 7 else f"street letter {i % 89}", i % 1500 == 7 or i % 50 == 3)
            for i in range(26_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean").repartition(4)
    scorer = fit(df.drop("toxic"), df.select("doc_id", F.col("toxic").cast("int").alias("toxic")), least_docs=9)
    assert scorer.weights["=zorgle"] > 0.5 and scorer.coefficients is not None


def test_calibration_adds_up_over_partitions(spark):
    """The sums of many tasks lead to the point where the penalized likelihood has no slope."""
    from tillroll.llm.toxicity import SUMMARY, Scorer

    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, SUMMARY + 1))
    y = rng.random(500) < 1 / (1 + np.exp(-(x @ np.arange(SUMMARY + 1) / 2 - 1)))
    rows = [(bool(b), [float(v) for v in a]) for a, b in zip(x, y)]
    scorer = Scorer(MODEL, {})
    scorer.calibrate(spark.createDataFrame(rows, "toxic boolean, x array<double>").repartition(7))
    b, whole = scorer.coefficients, np.column_stack([x, np.ones(500)])
    slope = whole.T @ (y - 1 / (1 + np.exp(-whole @ b))) - 0.1 * b * (np.arange(SUMMARY + 2) < SUMMARY + 1)
    assert np.abs(slope).max() < 1e-6
