import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from .test_decontaminate import slow_best  # noqa: E402
from .test_packing import check_pieces  # noqa: E402
from .test_secrets import slow_spans  # noqa: E402
from .test_simhash import slow_components, slow_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage gets and returns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        df = stage(spark, out[-1], SF)
        if stage is not pipeline.STAGES[-1][1]:
            assert df.schema.names == docs.schema.names and [f.dataType for f in df.schema] == [f.dataType for f in docs.schema]
        out.append(spark.createDataFrame(df.collect(), df.schema))
    return [df.collect() for df in out]


def test_language_stage_keeps_clean_documents(stages):
    docs, kept = stages[0], stages[1]
    assert set(kept) <= set(docs) and len(kept) >= 0.98 * len(docs)


def test_one_of_each_component_stays(stages):
    rows = stages[1]
    roots = slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in rows])
    assert Counter(stages[2]) == Counter(r for r in rows if roots[r["doc_id"]] == r["doc_id"])


def test_contaminated_documents_go(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in stages[2] if all(slow_best(r["text"], t) < 0.8 for t in items)]
    assert Counter(stages[3]) == Counter(clean) and len(clean) < len(stages[2])


def test_secrets_are_masked(stages):
    before, after = ({r["doc_id"]: r for r in rows} for rows in stages[3:5])
    assert set(before) == set(after)
    for doc_id, r in before.items():
        spans = slow_spans(r["text"])
        got = after[doc_id]["text"]
        assert (got == r["text"]) if not spans and "[SECRET]" not in got else "[SECRET]" in got
        assert slow_spans(got) == [] and after[doc_id]["n_chars"] == len(got)


def test_packing_covers_what_is_left(stages):
    check_pieces(stages[5], [(r["doc_id"], r["text"]) for r in stages[4]])


def test_run_equals_the_stages(spark, stages):
    whole = lambda rows: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    rows = pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stages[5]}
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in stages[4]])
    assert sum(whole(rows).values()) > 0


def test_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in pipeline.STAGES:
            df = stage(spark, docs, SF)
            docs = spark.createDataFrame(df.collect(), df.schema)
    assert docs.count() == 0
