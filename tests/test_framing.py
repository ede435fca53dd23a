"""Record borders of large landed files, found block by block."""

import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.sources import envelopes, framing
from test_ingest import CASES, loaded, person, put

values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(alphabet='ab"\\[]{},:\n é', max_size=6),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='k"\\{,', max_size=3), x, max_size=3), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(values, st.booleans())
def test_depth_and_commas_are_those_of_a_scan(value, pretty):
    text = json.dumps(value, indent=1 if pretty else None, ensure_ascii=False)
    s = framing.Structure(text.encode())
    depth, inside, escaped, at, commas = 0, False, False, [], 0
    for c in text:
        if inside:
            escaped, inside = (c == "\\" and not escaped), (escaped or c != '"')
        else:
            inside = c == '"'
            depth += (c in "[{") - (c in "]}")
            commas += c == ","
        at += [depth] * len(c.encode())
    assert s.depth.tolist() == at and s.rise == 0 and not s.broken and int(s.commas.sum()) == commas


@settings(max_examples=100, deadline=None)
@given(st.lists(values, min_size=1, max_size=6), st.integers(1, 40), st.booleans())
def test_blocks_deal_out_what_the_whole_holds(records, size, bare):
    """Whatever lines a block ends behind, the elements and the skeleton are those of the whole text."""
    text = json.dumps(records if bare else {"a": 1, "users": records, "total": 7}, indent=1, ensure_ascii=False)
    lines, blocks = text.split("\n"), []
    for i in range(0, len(lines), size):
        blocks.append("\n".join(lines[i:i + size]).encode())
    depth, member, element, found = (1 if bare else 0), 0, 0, {}
    for b in blocks:
        for m, e, t in framing.deal(b, depth, member, element):
            found.setdefault((m, e), []).append(t.decode())
        depths, commas, _ = framing.Structure(b).at_depths()
        at = {d + depth: c for d, c in zip(depths, commas)}
        member, element = member + at.get(1, 0), element + at.get(2, 0)
        depth += framing.Structure(b).rise
    skeleton = json.loads("".join(found.pop((framing.SKELETON, 0))))
    assert skeleton == ([] if bare else {"a": 1, "users": [], "total": 7})
    of = 0 if bare else 1
    assert [json.loads("\n".join(t)) for (m, _), t in sorted(found.items()) if m == of] == records
    assert all(m == of for m, _ in found)


def values_of(spark, root, whole_bytes, block_bytes, monkeypatch):
    monkeypatch.setattr(framing.framed_values, "__kwdefaults__", {"block_bytes": block_bytes, "skeleton_bytes": 1 << 20})
    lines = envelopes.read_lines(spark, root, "customers")
    return envelopes.split(envelopes.parse_records(envelopes.landed_values(lines, "customers", whole_bytes), "customers"))


@pytest.mark.parametrize("split", ["128m", "64k"])
def test_large_file_loads_in_blocks(spark, scratch, split, monkeypatch):
    """A pretty-printed file larger than any block: every record once, no block and no group near its size."""
    rng = random.Random(3)
    users = [person(i, email=rng.choice(['a,b', 'q"q', "[{", "}]", "\\", "é"]) * rng.randint(0, 40),
                    address={"city": "x" * rng.randint(0, 30)}) for i in range(3000)]
    users[7] = person("seven")
    path = put(scratch, "customers", "2020/01/05/big.json", {"skip": 0, "more": [{"id": 5}, [1, 2]], "users": users, "total": 3000})
    put(scratch, "customers", "2020/01/06/list.json", [person(10_000 + i) for i in range(500)])
    put(scratch, "customers", "2020/01/07/small.json", {"users": [person(20_000)], "total": 1})
    size = os.path.getsize(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        good, bad = values_of(spark, scratch, 10_000, 20_000, monkeypatch)
        ids = [i for i in range(3000) if i != 7] + [10_000 + i for i in range(500)] + [20_000]
        assert loaded(good) == sorted(ids)
        assert [json.loads(r["text"])["id"] for r in bad.collect()] == ["seven"]
        totals = {os.path.basename(r["_source"]): r["_total"] for r in good.select("_source", "_total").distinct().collect()}
        assert totals == {"big.json": 3000, "list.json": None, "small.json": 1}
        got = {r["user"]["id"]: r["user"]["email"] for r in good.where("_total = 3000").collect()}
        assert got == {u["id"]: u["email"] for u in users if u["id"] != "seven"}
        lines = envelopes.read_lines(spark, scratch, "customers").where(F.col("_source").endswith("big.json"))
        blocks = framing.blocks_of(lines, 20_000).select(F.octet_length("text").alias("n")).collect()
        assert size > 400_000 and max(b["n"] for b in blocks) < 25_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_faulty_large_files_lose_no_text(spark, scratch, monkeypatch):
    users = [person(i) for i in range(200)]
    whole = json.dumps({"users": users}, indent=2)
    texts = {"cut.json": whole[:-40], "two.json": whole + whole, "after.json": whole + "\nx", "quote.json": whole.replace('"P7"', '"P7', 1),
             "scalar.json": "5\n" * 9000, "skeleton.json": json.dumps({f"k{i}": i for i in range(100_000)}, indent=1),
             "rows.json": "\n".join(json.dumps(u) for u in users), "single.json": json.dumps({"users": dict(users[0], n="x" * 9000)}, indent=2)}
    for name, text in texts.items():
        put(scratch, "customers", name, text)
    good, bad = values_of(spark, scratch, 5000, 3000, monkeypatch)
    assert good.count() == 0
    kept = {}
    for r in bad.collect():
        name = os.path.basename(r["_source"])
        kept[name] = kept.get(name, "") + r["text"]
    letters = lambda t: sorted(c for c in t if not c.isspace() and c != ",")
    assert set(kept) == set(texts)
    for name, text in texts.items():
        assert letters(kept[name]) == letters(text), name


def test_every_kind_of_small_file_is_framed_alike(spark, scratch, monkeypatch):
    """With every file taken as large, sound files give the same rows as whole ones do."""
    sound = [c for c in CASES if not c[3] and c[0].endswith(".json")]
    for name, text, _, _ in sound:
        put(scratch, "customers", name, text)
    single = [10]  # a record without its list is a fault in a large file
    good, bad = values_of(spark, scratch, 0, 10, monkeypatch)
    assert loaded(good) == sorted(i for c in sound for i in c[2] if i not in single)
    assert {os.path.basename(r["_source"]) for r in bad.collect()} == {"single.json"}
