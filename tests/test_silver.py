"""Silver rules on hand-made rows: the traps the reference's behaviour implies."""

from pyspark.sql import functions as F

from cargolens.operators import silver
from tests.helpers import frame, shipment


def _flag_of(spark, **kw):
    row = silver.flagged(frame(spark, [shipment(**kw)])).collect()[0]
    return row


def test_status_is_upper_trimmed_and_valid(spark):
    r = _flag_of(spark, status="  delivered ")
    assert r["status"] == "DELIVERED"
    assert r["is_valid_status"] is True
    assert r["dq_flag"] == "PASS"
    assert r["is_delivered"] is True and r["is_delayed"] is False


def test_trim_removes_spaces_only_tab_survives(spark):
    # T5: a tab is not trimmed, so the status is invalid and the row fails.
    r = _flag_of(spark, status="\tDELAYED")
    assert r["status"] == "\tDELAYED"
    assert r["is_valid_status"] is False
    assert r["dq_flag"] == "FAIL"


def test_carrier_origin_destination_trimmed_case_kept(spark):
    r = _flag_of(spark, carrier=" Blue Dart ", origin=" Delhi ", destination="pune ")
    assert (r["carrier"], r["origin"], r["destination"]) == ("Blue Dart", "Delhi", "pune")


def test_blank_origin_passes_and_carrier_not_validated(spark):
    # T4: '' is not null; carrier is never checked.
    r = _flag_of(spark, origin="   ", carrier=None)
    assert r["origin"] == ""
    assert r["has_origin"] is True
    assert r["dq_flag"] == "PASS"


def test_null_status_is_null_flag_and_fail(spark):
    r = _flag_of(spark, status=None)
    assert r["is_valid_status"] is None
    assert r["dq_flag"] == "FAIL"


def test_missing_places_fail(spark):
    assert _flag_of(spark, origin=None)["dq_flag"] == "FAIL"
    assert _flag_of(spark, destination=None)["dq_flag"] == "FAIL"


def test_weight_edges_and_categories(spark):
    # T6: null weight falls to EXTRA_HEAVY, <= 0 to LIGHT (both FAIL rows).
    cases = {
        -1.0: ("LIGHT", "FAIL"),
        0.0: ("LIGHT", "FAIL"),
        0.5: ("LIGHT", "PASS"),
        1.0: ("MEDIUM", "PASS"),
        9.99: ("MEDIUM", "PASS"),
        10.0: ("HEAVY", "PASS"),
        24.99: ("HEAVY", "PASS"),
        25.0: ("EXTRA_HEAVY", "PASS"),
        None: ("EXTRA_HEAVY", "FAIL"),
    }
    rows = [shipment(shipment_id=i, weight_kg=w) for i, w in enumerate(cases)]
    got = {
        r["shipment_id"]: (r["weight_category"], r["dq_flag"])
        for r in silver.flagged(frame(spark, rows)).collect()
    }
    for i, w in enumerate(cases):
        assert got[i] == cases[w], w


def test_normalize_is_idempotent(spark):
    rows = [shipment(shipment_id=i, status=s, carrier=c) for i, (s, c) in enumerate(
        [(" shipped ", " DHL "), ("lost", "FedEx"), (None, None), ("\tdelayed", "  ")]
    )]
    df = frame(spark, rows)
    once = silver.normalize(df)
    twice = silver.normalize(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_silver_keeps_pass_rows_only_with_22_columns(spark):
    rows = [shipment(shipment_id=1), shipment(shipment_id=2, status="LOST")]
    out = silver.silver(frame(spark, rows))
    assert len(out.columns) == 22
    assert [r["shipment_id"] for r in out.collect()] == [1]


def test_quarantine_reasons_listed_per_row(spark):
    rows = [
        shipment(shipment_id=1, status="LOST", weight_kg=0.0),
        shipment(shipment_id=2, origin=None, destination=None),
        shipment(shipment_id=3),
    ]
    flagged = silver.flagged(frame(spark, rows))
    q = {r["shipment_id"]: r["reasons"] for r in silver.quarantine(flagged).collect()}
    assert q == {1: ["bad_status", "bad_weight"], 2: ["no_origin", "no_destination"]}
    counts = {r["reason"]: r["n"] for r in silver.quarantine_reason_counts(flagged).collect()}
    assert counts == {"bad_status": 1, "bad_weight": 1, "no_origin": 1, "no_destination": 1}


def test_run_ts_stamps_every_row_alike(spark):
    ts = F.lit("2026-01-01 00:00:00").cast("timestamp")
    rows = [shipment(shipment_id=i) for i in range(5)]
    stamps = {r["processed_at"] for r in silver.flagged(frame(spark, rows), ts).collect()}
    assert len(stamps) == 1


def test_typed_timestamps_tolerate_bad_text(spark):
    rows = [shipment(shipment_id=1, shipped_at="not a time"), shipment(shipment_id=2)]
    got = {
        r["shipment_id"]: r["shipped_ts"]
        for r in silver.with_typed_timestamps(frame(spark, rows)).collect()
    }
    assert got[1] is None and got[2] is not None
