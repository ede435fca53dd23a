"""Landing, loading and incremental loading of JSON files (S1-S8, U1, U2, K1,
K6, S18, T1), on files written into a scratch folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tillroll.plans.pipeline import ENTITY_FILES, load_bronze
from tillroll.schemas import table_name
from tillroll.sources import envelopes
from tillroll.streaming import QUARANTINED, read_loaded

PEOPLE = [{"id": 71, "firstName": "Mira", "lastName": "Okafor", "email": "mira@shop.test", "address": {"city": "Turku"}},
          {"id": 72, "firstName": "Jun", "lastName": "Reyes", "email": "jun@shop.test"}]
BASKETS = [
    {"id": 501, "userId": 71, "total": 31.5, "discountedTotal": 30.25, "totalProducts": 2, "totalQuantity": 5,
     "products": [{"id": 9, "title": "kettle", "quantity": 1, "discountedTotal": 20.25},
                  {"id": 11, "title": "spoon", "quantity": 4, "discountedTotal": 10.0}]},
    {"id": 502, "userId": 72, "total": 12.0, "discountedTotal": 12.0, "totalProducts": 1, "totalQuantity": 1,
     "products": [{"id": 11, "title": "spoon", "quantity": 1, "discountedTotal": 12.0}]},
]


def put(root, entity, name, payload, indent=2):
    """Write a landed file: text as it is, anything else as JSON."""
    path = os.path.join(root, entity, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload, indent=indent))
    return path


def person(i, **more):
    return {"id": i, "firstName": f"P{i}", "lastName": "Q", **more}


# (name, file text, ids loaded, rows quarantined): every framing, shape, depth and fault.
CASES = [
    ("2020/01/05/pretty.json", json.dumps({"users": [person(1), person(2)], "total": 2}, indent=2), [1, 2], 0),
    ("2020/01/05/compact.json", json.dumps({"users": [person(3)], "total": 1}), [3], 0),
    ("2020/01/05/lines.json", "\n".join(json.dumps({"users": [person(i)]}) for i in (4, 5, 6)) + "\n", [4, 5, 6], 0),
    ("list.json", json.dumps([person(7), person(8)], indent=1), [7, 8], 0),
    ("a/b/c/d/e/list_line.json", json.dumps([person(9)]), [9], 0),
    ("2020/single.json", json.dumps({"users": person(10)}, indent=2), [10], 0),
    ("2020/01/rows.json", '{"users": [\n' + ",\n".join(json.dumps(person(i)) for i in (11, 12)) + "\n]}", [11, 12], 0),
    ("2020/01/type_error.json", json.dumps({"users": [person(13), person("abc"), person(14)]}, indent=2), [13, 14], 1),
    ("2020/01/type_error_lines.json", json.dumps({"users": [person(15), person(16, address="nowhere")]}), [15], 1),
    ("2020/01/broken.json", '{"users": [ {"id": 17, ', [], 1),
    ("2020/01/cut_lines.json", json.dumps({"users": [person(18)]}) + '\n{"users": [{"id": 19', [18], 1),
    ("2020/01/two_values.json", json.dumps({"users": [person(20)]}, indent=2) + json.dumps({"users": [person(21)]}, indent=2), [], 1),
    ("2020/01/null.json", '{"users": null}', [], 0),
    ("2020/01/empty_list.json", '{"users": [], "total": 9}', [], 0),
    ("2020/01/no_key.json", '{"message": "busy"}', [], 0),
    ("2020/01/scalar.json", "5", [], 1),
    ("2020/01/scalar_record.json", '{"users": [5, null]}', [], 2),
    ("2020/01/blank.json", " \n\n", [], 0),
    ("2020/01/drift.json", json.dumps({"users": [person(22, shoeSize=44)], "page": 1}), [22], 0),
    ("2020/01/notes.txt", "not json", [], 0),
]


def loaded(rows):
    return sorted(r["user"]["id"] for r in rows.collect())


@pytest.mark.parametrize("full", [True, False])
def test_loaded_and_quarantined_rows_account_for_all_that_was_landed(spark, scratch, full):
    landing = os.path.join(scratch, "landing")
    for name, text, _, _ in CASES:
        put(landing, "customers", name, text)
    for entity in ENTITY_FILES[1:]:
        os.makedirs(os.path.join(landing, entity))
    out = load_bronze(spark, landing, os.path.join(scratch, "bronze"), full=full)
    assert loaded(read_loaded(spark, out["folder"], "customers")) == sorted(i for c in CASES for i in c[2])
    bad = read_loaded(spark, out["folder"], "customers", QUARANTINED).collect()
    per_file = {name: sum(r["_source"].endswith("/" + name) for r in bad) for name, *_ in CASES}
    assert per_file == {name: n for name, _, _, n in CASES}
    assert out["loaded"]["products"] == out["quarantined"]["orders"] == 0
    # The raw text of what was not loaded is kept.
    text = next(r["_bad"] for r in bad if r["_source"].endswith("/type_error.json"))
    assert json.loads(text)["id"] == "abc"
    good, kept = envelopes.load(spark, landing, "customers")
    assert loaded(good) == sorted(i for c in CASES for i in c[2]) and kept.count() == len(bad)


def test_landed_pages_are_read_back_whole(spark, scratch):
    recs = spark.range(0, 250).select(F.col("id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"))
    out = envelopes.land(recs, scratch, "products", "2020-02-03T04:05:06", page_size=100, total=250)
    assert out.endswith("products/2020/02/03/products_20200203_040506")
    good, bad = envelopes.load(spark, scratch, "products")
    assert sorted(r["product"]["id"] for r in good.collect()) == list(range(250)) and bad.count() == 0
    values = envelopes.landed_values(envelopes.read_lines(spark, scratch, "products"), "products")
    sizes = [r["n"] for r in values.select(F.json_array_length(F.get_json_object("text", "$.products")).alias("n")).collect()]
    assert sum(sizes) == 250 and max(sizes) <= 100
    summary = envelopes.validate_landing(envelopes.landing_manifest(spark, scratch)).collect()
    assert {(r["entity"], r["landing_date"]) for r in summary} == {("products", "2020-02-03")}


def test_a_fetch_lands_once(spark, scratch):
    """A call that is repeated adds nothing; what a killed one left is written anew."""
    recs = spark.range(30).select("id")
    out = envelopes.land(recs, scratch, "products", "2020-02-03T04:05:06", page_size=10)
    assert envelopes.land(recs, scratch, "products", "2020-02-03T04:05:06", page_size=10) == out
    assert envelopes.load(spark, scratch, "products")[0].count() == 30
    os.remove(os.path.join(out, "_SUCCESS"))
    put(out, "", "part-left.json", '{"products": [{"id": 99}]}')
    envelopes.land(recs, scratch, "products", "2020-02-03T04:05:06", page_size=10, pretty=True)
    good, bad = envelopes.load(spark, scratch, "products")
    assert sorted(r["product"]["id"] for r in good.collect()) == list(range(30)) and bad.count() == 0
    with open(next(os.path.join(out, f) for f in os.listdir(out) if f.endswith(".json"))) as f:
        assert len(f.readlines()) > 10  # one envelope over many lines


def test_completeness_is_judged_per_fetch(spark, scratch):
    half = [person(1), person(2)]
    for day in (1, 2, 3):  # the same half of four records, landed three times
        put(scratch, "customers", f"2020/01/0{day}/customers_2020010{day}_120000.json", {"users": half, "total": 4})
    put(scratch, "customers", "2020/01/04/customers_20200104_120000.json", {"users": [person(i) for i in range(4)], "total": 4})
    put(scratch, "customers", "2020/01/05/customers_20200105_120000/part-0.json", {"users": half, "total": 4})
    put(scratch, "customers", "2020/01/05/customers_20200105_120000/part-1.json", {"users": [person(3), person(4)], "total": 4})
    put(scratch, "customers", "2020/01/06/other.json", {"users": half})
    good, _ = envelopes.load(spark, scratch, "customers")
    found = {r["batch"].split("/")[-1]: (r["landed"], r["reported_total"], r["complete"])
             for r in envelopes.completeness({"customers": good}).collect()}
    assert found == {**{f"customers_2020010{d}_120000": (2, 4, False) for d in (1, 2, 3)},
                     "customers_20200104_120000": (4, 4, True), "customers_20200105_120000": (4, 4, True),
                     "other.json": (2, 2, True)}


def test_counts_and_lines(spark, scratch):
    put(scratch, "customers", "2020/01/05/customers_20200105_101500.json", {"users": PEOPLE, "total": 5})
    put(scratch, "orders", "2020/01/05/orders_20200105_101500.json", {"carts": BASKETS, "total": 2})
    people, _ = envelopes.load(spark, scratch, "customers")
    counts = envelopes.batch_counts(people, "customers").collect()
    assert [(r["records"], r["source"].endswith("customers_20200105_101500.json")) for r in counts] == [(2, True)]
    assert {r["user"]["id"]: r["user"]["address"] and r["user"]["address"]["city"] for r in people.collect()} == {71: "Turku", 72: None}
    carts, _ = envelopes.load(spark, scratch, "orders")
    got = sorted((r["cart_id"], r["line"]["id"], r["line"]["quantity"]) for r in envelopes.explode_lines(carts).collect())
    assert got == [(501, 9, 1), (501, 11, 4), (502, 11, 1)]
    totals = {r["entity"]: (r["records"], r["files"]) for r in envelopes.load_totals({"orders": carts}).collect()}
    assert totals == {"orders": (2, 1)}


def test_table_naming():
    assert table_name("customers") == "stg_customers" and table_name("widgets") == "stg_widgets"


def test_missing_folder_is_an_error(spark, scratch):
    with pytest.raises(FileNotFoundError):
        envelopes.load(spark, scratch, "products")
    with pytest.raises(FileNotFoundError):
        load_bronze(spark, os.path.join(scratch, "none"), os.path.join(scratch, "bronze"))


def test_validate_landing_raises_when_empty(spark, scratch):
    os.makedirs(os.path.join(scratch, "empty"), exist_ok=True)
    with pytest.raises(Exception):
        envelopes.validate_landing(envelopes.landing_manifest(spark, os.path.join(scratch, "empty")))


def test_batch_then_incremental_then_batch(spark, scratch):
    """New files are appended once; a full reload starts anew, and incremental loads go on from it."""
    landing, bronze = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    for entity in ENTITY_FILES:
        os.makedirs(os.path.join(landing, entity))
    put(landing, "orders", "2020/01/05/o1.json", {"carts": BASKETS})

    def load(full):
        out = load_bronze(spark, landing, bronze, full)
        return out["loaded"]["orders"], out["quarantined"]["orders"]

    assert load(True) == (2, 0) and load(False) == (2, 0) and load(False) == (2, 0)
    put(landing, "orders", "2020/01/06/o2.json", {"carts": [dict(BASKETS[0], id=503)]})
    put(landing, "orders", "deep/er/than/others/o3.json", '{"carts": [')
    assert load(False) == (3, 1) and load(False) == (3, 1)
    assert load(True) == (3, 1) and load(False) == (3, 1)
    put(landing, "orders", "o4.json", [dict(BASKETS[1], id=504)])
    assert load(False) == (4, 1)


def test_frozen_schema_from_first_file(spark, scratch):
    assert envelopes.create_raw_table_if_needed(spark, "raw_c_none", scratch, "customers") is False
    put(scratch, "customers", "2020/06/30/b.json", {"users": [{"id": 9, "extra": "x"}]})
    put(scratch, "customers", "2020/06/29/a.json", {"users": [{"id": 1, "email": "e"}], "total": 1})
    schema = envelopes.frozen_schema(spark, scratch, "customers")
    assert sorted(schema["users"].dataType.elementType.fieldNames()) == ["email", "id"]  # from the earliest file only
    assert envelopes.create_raw_table_if_needed(spark, "raw_c", scratch, "customers") is True
    assert envelopes.create_raw_table_if_needed(spark, "raw_c", scratch, "customers") is True  # it exists
    assert spark.table("raw_c").count() == 0 and "users" in spark.table("raw_c").columns
