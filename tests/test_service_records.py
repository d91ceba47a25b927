from __future__ import annotations

import copy
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright.operators import items, quality, star
from millwright.sources import files

#: A record of our own that breaks no rule: three services, four parts, one of them without a code.
GOOD = {
    "service_record_id": "R1",
    "dealer": {"dealer_id": "D1", "dealer_name": "North", "dealer_location": "Dock 4"},
    "vehicle": {"vin": "V1", "model": "Delivery van", "year": 2017, "odometer_reading": 183402},
    "service_details": {
        "service_date": "2024-03-09T18:30:00Z",
        "service_advisor_name": "Ari",
        "total_cost": 1312.45,
        "services_performed": [
            {"service_name": "Clutch", "service_cost": 640.0, "technician_notes": "worn to the rivets"},
            {"service_name": "Wheel alignment", "service_cost": 89.9, "service_code": "W7"},
            {"service_name": "Road test", "service_cost": 0.0},
        ],
        "parts_used": [
            {"part_name": "Clutch disc", "quantity": 1, "unit_cost": 312.25, "part_code": "K-20"},
            {"part_name": "Bearing", "quantity": 3, "unit_cost": 41.1},
            {"part_name": "Bolt", "quantity": 12, "unit_cost": 0.75, "part_code": "B-8"},
            {"part_name": "Grease", "quantity": 2, "unit_cost": 69.0},
        ],
    },
    "customer": {"customer_id": "C1", "customer_name": "Wita"},
}
DETAILS = GOOD["service_details"]
QUANTITIES = [p["quantity"] for p in DETAILS["parts_used"]]


def changed(path=None, value=None, drop=False, base=GOOD):
    out = copy.deepcopy(base)
    if path:
        *parents, last = path.split(".")
        node = out
        for p in parents:
            node = node[int(p)] if p.isdigit() else node[p]
        if drop:
            del node[last]
        else:
            node[last] = value
    return out


def parsed(spark, *documents):
    rows = [
        (f"d{i}", pos, r if isinstance(r, str) else json.dumps(r)) for i, doc in enumerate(documents) for pos, r in enumerate(doc)
    ]
    return quality.parse_records(spark.createDataFrame(rows, "doc_id string, pos long, raw string"))


def verdicts(spark, *documents):
    return [r["rule"] for r in quality.judge_documents(parsed(spark, *documents)).orderBy("doc_id").collect()]


def test_valid_record_gives_the_whole_star(spark):
    rows = parsed(spark, [GOOD])
    tables = star.star_tables(quality.accept(rows, quality.judge_documents(rows)))
    assert {n: t.count() for n, t in tables.items()} == {
        "fact_service_records": 1,
        "dim_dealer": 1,
        "dim_vehicle": 1,
        "dim_customer": 1,
        "dim_services_performed": len(DETAILS["services_performed"]),
        "dim_parts_used": len(DETAILS["parts_used"]),
    }
    fact = tables["fact_service_records"].first()
    assert fact["service_datetime_utc"] == datetime(2024, 3, 9, 18, 30)
    assert fact["service_datetime_wib"] == datetime(2024, 3, 10, 1, 30)
    assert fact["total_cost"] == DETAILS["total_cost"]
    assert {"dealer_name", "model"}.isdisjoint(tables["fact_service_records"].columns)
    assert tables["dim_parts_used"].agg(F.sum("quantity")).first()[0] == sum(QUANTITIES)
    assert tables["dim_vehicle"].first()["odometer_reading"] == GOOD["vehicle"]["odometer_reading"]
    services = tables["dim_services_performed"].collect()
    assert {s["service_record_id"] for s in services} == {"R1"} and {s["service_advisor_name"] for s in services} == {"Ari"}


def test_negative_cost_rejects_the_document(spark):
    assert verdicts(spark, [changed("service_details.total_cost", -100.0)]) == ["fact_service_records.total_cost: at_least_0"]


CASES = [
    ("dealer.dealer_id", None, False, "dim_dealer.dealer_id: not_null"),
    ("vehicle.vin", None, False, "dim_vehicle.vin: not_null"),
    ("vehicle.odometer_reading", None, False, "dim_vehicle.odometer_reading: not_null"),
    ("vehicle.odometer_reading", "far", False, "dim_vehicle.odometer_reading: int"),
    ("vehicle.odometer_reading", 10.5, False, "dim_vehicle.odometer_reading: int"),
    ("vehicle.odometer_reading", "12", False, None),
    ("vehicle.year", None, False, None),
    ("vehicle.year", None, True, "dim_vehicle.year: missing_key"),
    ("dealer.dealer_name", None, False, None),
    ("dealer.dealer_name", None, True, "dim_dealer.dealer_name: missing_key"),
    ("customer.customer_id", None, False, "dim_customer.customer_id: not_null"),
    ("service_record_id", None, False, "fact_service_records.service_record_id: not_null"),
    ("service_details.service_date", "someday", False, "fact_service_records.service_date: timestamp"),
    ("service_details.total_cost", None, False, "fact_service_records.total_cost: not_null"),
    ("service_details.services_performed", [], False, None),
    ("service_details.services_performed", None, False, None),
    ("service_details.services_performed", None, True, "dim_services_performed.services_performed: missing_key"),
    ("service_details.services_performed", "none", False, "dim_services_performed.services_performed: array"),
    ("service_details.service_advisor_name", None, False, None),
    ("service_details.service_advisor_name", None, True, "dim_services_performed.service_advisor_name: missing_key"),
    ("service_details.services_performed.0.service_cost", -1, False, "dim_services_performed.service_cost: at_least_0"),
    ("service_details.services_performed.1.service_name", None, False, "dim_services_performed.service_name: not_null"),
    ("service_details.parts_used", None, True, "dim_parts_used.parts_used: missing_key"),
    ("service_details.parts_used.0.quantity", 0, False, "dim_parts_used.quantity: at_least_1"),
    ("service_details.parts_used.0.quantity", "two", False, "dim_parts_used.quantity: int"),
    ("service_details.parts_used.0.quantity", "3", False, None),
    ("service_details.parts_used.0.quantity", 3.0, False, None),
    ("service_details.total_cost", "12.5", False, None),
    ("service_details.total_cost", "dear", False, "fact_service_records.total_cost: double"),
    ("service_details.parts_used.1.unit_cost", -0.01, False, "dim_parts_used.unit_cost: at_least_0"),
]


def test_rules(spark):
    got = quality.judge_documents(parsed(spark, *[[changed(p, v, d)] for p, v, d, _ in CASES])).collect()
    by_doc = {r["doc_id"]: r["rule"] for r in got}
    assert [by_doc[f"d{i}"] for i in range(len(CASES))] == [c[3] for c in CASES]


def test_values_written_as_text_are_repaired(spark):
    odd = changed("service_details.parts_used.1.quantity", "4", base=changed("vehicle.odometer_reading", "12.0"))
    rows = parsed(spark, [odd])
    assert star.dim_vehicle(rows).first()["odometer_reading"] == 12
    assert [r["quantity"] for r in star.dim_parts_used(rows).collect()] == [QUANTITIES[0], 4, *QUANTITIES[2:]]


def test_first_table_in_order_gives_the_reason(spark):
    both = changed("dealer.dealer_id", None, base=changed("service_details.total_cost", -1))
    assert verdicts(spark, [both], [changed("service_details.total_cost", -1), changed("customer.customer_id", None)]) == [
        "dim_dealer.dealer_id: not_null",
        "dim_customer.customer_id: not_null",
    ]


def test_one_bad_record_rejects_its_document_only(spark):
    rows = parsed(spark, [GOOD, changed("service_details.total_cost", -1)], [GOOD], ["{broken"])
    judged = quality.judge_documents(rows)
    assert [(r["doc_id"], r["records"], r["rule"]) for r in judged.orderBy("doc_id").collect()] == [
        ("d0", 2, "fact_service_records.total_cost: at_least_0"),
        ("d1", 1, None),
        ("d2", 1, "document: unreadable"),
    ]
    assert [r["doc_id"] for r in quality.accept(rows, judged).collect()] == ["d1"]
    assert quality.reject(rows, judged).count() == 3


def test_only_the_first_record_of_a_vehicle_is_checked_and_kept(spark):
    later = changed("vehicle.odometer_reading", None)
    assert verdicts(spark, [GOOD, later], [later, GOOD]) == [None, "dim_vehicle.odometer_reading: not_null"]
    second = changed("dealer.dealer_name", "South")
    rows = parsed(spark, [GOOD, second], [second])
    kept = {(r["doc_id"], r["dealer_id"], r["dealer_name"]) for r in star.dim_dealer(rows).collect()}
    assert kept == {("d0", "D1", "North"), ("d1", "D1", "South")}


def test_key_missing_in_some_records_only(spark):
    assert verdicts(spark, [GOOD, changed("vehicle.year", drop=True)]) == [None]


def test_posted_batches_are_checked_more_strictly(spark):
    rows = parsed(
        spark,
        [GOOD],
        [changed("dealer.dealer_name", None)],
        [changed("vehicle.year", "soon")],
        [changed("service_details.parts_used", drop=True)],
        [changed("service_details.parts_used.0.quantity", None)],
    )
    judged = quality.judge_posted(rows).orderBy("doc_id").collect()
    assert [r["rule"] is None for r in judged] == [True, False, False, True, False]


def test_documents_are_read_whole(spark, tmp_path):
    day = tmp_path / "date=2025-11-21"
    day.mkdir()
    (day / "a.json").write_text(json.dumps([GOOD, changed("service_record_id", "R2")], indent=2))
    (day / "b.json").write_text("oops")
    (day / "note.txt").write_text("[]")
    raw = files.documents(spark, str(tmp_path))
    assert raw.select(F.countDistinct("doc_id")).first()[0] == 2
    assert {r[0] for r in raw.select(files.doc_date(F.col("doc_id"))).collect()} == {"2025-11-21"}
    judged = quality.judge_documents(quality.parse_records(raw)).collect()
    assert {(r["records"], r["rule"]) for r in judged} == {(1, "document: unreadable"), (2, None)}
    assert files.documents(spark, str(tmp_path), datetime(2025, 11, 21).date()).count() == 3


def test_items_hold_exact_decimals_and_the_last_put_wins(spark):
    raw = spark.createDataFrame(
        [("d0", 0, json.dumps(GOOD)), ("d1", 0, json.dumps(changed("service_details.total_cost", 0.1)))], "doc_id string, pos long, raw string"
    )
    last = items.last_record_per_key(raw, "service_record_id", "doc_id", "pos")
    kept = items.item_rows(last, "service_record_id").first()["item"]
    kept = items.with_numbers(kept.asDict(recursive=True))
    assert kept["service_details"]["total_cost"] == Decimal("0.1")
    assert kept["service_details"]["parts_used"][1]["unit_cost"] == Decimal(str(DETAILS["parts_used"][1]["unit_cost"]))
    assert kept["vehicle"]["odometer_reading"] == GOOD["vehicle"]["odometer_reading"]


@pytest.mark.parametrize("value", [0.1, 1e-7, 123456.789, 1e-11, 0.12345678901234, 1e30])
def test_decimal_goes_through_the_shortest_text(spark, value):
    row = items.floats_to_decimals(spark.createDataFrame([(value,)], "x double")).first()
    assert items.with_numbers(row.asDict(recursive=True))["x"] == Decimal(repr(value))
