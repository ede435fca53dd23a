import re
from hashlib import sha256

import duckdb

from tillroll.llm.licenses import KNOWN, SPELLINGS, oracle_sql, scan_licenses
from tillroll.llm.queries import op10_licenses


def canonical(text):
    out = []
    for line in text.split("\n"):
        low = line.lower()
        low = "" if re.search(r"^[ \t]*(copyright|\(c\)|©)", low) else low
        words = f" {re.sub('[^a-z0-9]+', ' ', low).strip()} "
        for a, b in SPELLINGS:
            words = words.replace(f" {a} ", f" {b} ")
        out.append(words.strip())
    return out


def whole(text):
    return " ".join(x for x in canonical(text) if x)


def slow(docs):
    known = {}
    for i, t in sorted(KNOWN, reverse=True):
        known[whole(t)] = i
    rows = []
    for d, t in docs:
        for n, x in enumerate([whole(t or ""), *canonical(t or "")]):
            if x in known:
                rows.append((d, "line" if n else "document", n, known[x], sha256(x.encode()).hexdigest()))
    return sorted(rows, key=repr)


def test_query_equals_brute_force_and_sql(spark):
    path = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    rows = sorted((tuple(r) for r in op10_licenses(spark, path).collect()), key=repr)
    assert rows == slow(docs) and rows
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{path}/documents.parquet'")
    assert sorted(con.sql(oracle_sql()).fetchall(), key=repr) == rows


def test_variants_of_whole_texts(spark):
    mit = next(t for i, t in KNOWN if i == "MIT" and "Permission" in t)
    texts = [mit, "Copyright (c) 2020 A. Author\n" + mit.upper(), mit.replace("\n", "\r\n  ").replace("sublicense", "sub-license"),
             mit + " and more", "All Rights Reserved", "Released under the MIT Licence!", "(c) 2020 me"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["license_id"]) for r in scan_licenses(df).where("unit = 'document'").collect()}
    assert found == {(0, "MIT"), (1, "MIT"), (2, "MIT"), (4, "Proprietary"), (5, "MIT")}


def test_no_python_in_the_plan(spark, sample_docs):
    plan = scan_licenses(sample_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_edge_rows(spark, edge_docs, no_docs):
    assert scan_licenses(edge_docs).count() == 0 and scan_licenses(no_docs).count() == 0
    many = spark.createDataFrame([(None, "All rights reserved.\n" * 5000, 1)], "doc_id long, text string, digest int")
    assert scan_licenses(many).where("unit = 'line'").count() == 5000


def wrapped(text, width):
    """Each paragraph of a text on lines of at most ``width`` characters, or on one line."""
    import textwrap

    parts = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) if width else p for p in parts)


def test_entire_texts_are_found_at_any_width(spark):
    from tillroll.llm.licenses import known_texts

    texts = [(i, t) for i, t in known_texts() if len(t) > 500]
    assert {i for i, _ in texts} == {"MIT", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause",
                                     "BSD-3-Clause", "CC0-1.0", "Unlicense"}
    # The GNU texts begin with a notice inside a paragraph; their own wrap is looked up.
    cases = [(i, t) for i, t in texts] + [
        (i, "Copyright (c) 2020 A. Author\n\n" + wrapped(t, n)) for i, t in texts if "GPL" not in i for n in (0, 60, 72, 80, 100, 120)]
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(cases)], "doc_id long, text string")
    found = {r["doc_id"]: r["license_id"] for r in scan_licenses(df).where("unit = 'document'").collect()}
    assert [(i, found.get(n)) for n, (i, _) in enumerate(cases)] == [(i, i) for i, _ in cases]


def test_notices_and_words_of_licences(spark):
    mit = next(t for i, t in KNOWN if i == "MIT" and "Permission" in t)
    notices = ["Copyright (c) 2020 A", "Copyright 2020 A", "COPYRIGHT: 2020", "(C) 2020 A", "© Acme", "Copyright Google LLC",
               "Copyright The Linux Foundation and its contributors", "Copyright by A", "Copyright [yyyy] [name]", "(c) A. Author"]
    words = ["COPYRIGHT HOLDERS BE LIABLE", "copyright notice", "(c) You must retain", "copyright", "Copyright law"]
    df = spark.createDataFrame([(n, f"{x}\n{mit}") for n, x in enumerate(notices + words)], "doc_id long, text string")
    found = {r["doc_id"] for r in scan_licenses(df).where("unit = 'document'").collect()}
    assert found == set(range(len(notices)))


def test_sql_equals_the_operator_on_entire_licences(spark):
    """Whole texts at several widths, notices of all kinds, and words of licences that look like notices."""
    import duckdb

    from tillroll.llm.licenses import known_texts, oracle_sql

    whole = [t for _, t in known_texts()] + ["Copyright (c) 2020 A\n\n" + wrapped(t, n) for _, t in known_texts() if len(t) > 500
                                             for n in (0, 72)]
    heads = ["Copyright (c) 2020 A", "(C) 2020 A", "© Acme", "Copyright Google LLC", "copyright: a. author", "copyright a notice",
             "Copyright The Linux Foundation and its contributors", "(c) You must retain", "copyright", "Copyright law", "(c) A. Author",
             "COPYRIGHT HOLDERS BE LIABLE", "copyright   by A", "copyright treaty", "copyright  and", "copyright  notice-board"]
    mit = next(t for i, t in KNOWN if i == "MIT" and "Permission" in t)
    rows = [(n, t) for n, t in enumerate(whole + [f"{h}\n{mit}" for h in heads] + [f"{h} Released under the MIT Licence." for h in heads]
                                         + ["Released under the\nMIT License.", None, "", "x\nAll rights reserved.\n"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r[c] for c in ("doc_id", "unit", "line_no", "license_id", "digest")) for r in scan_licenses(df).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.sql(oracle_sql()).fetchall()) == got and len(got) > len(whole)
