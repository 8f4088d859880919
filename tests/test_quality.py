"""Silver checks (Q1) and operational constraints (Q2) on hand rows."""

import pytest
from pyspark.sql import functions as F

from cargolens.operators import quality, silver
from tests.helpers import frame, shipment


def _checks(spark, rows):
    df = silver.flagged(frame(spark, rows)) if rows else silver.flagged(frame(spark, []))
    return {r["check_name"]: r for r in quality.silver_checks(df).collect()}


def test_nine_checks_all_pass_on_clean_rows(spark):
    rows = [shipment(shipment_id=i) for i in range(60)]
    got = _checks(spark, rows)
    assert len(got) == 9
    assert all(r["passed"] for r in got.values())
    assert got["Minimum row count >= 50"]["actual"] == 60.0
    assert got["All weights are positive"]["actual"] == 5.0


def test_row_count_and_duplicates(spark):
    rows = [shipment(shipment_id=i % 3) for i in range(10)]
    got = _checks(spark, rows)
    assert got["Minimum row count >= 50"]["passed"] is False
    dup = got["No duplicate shipment IDs"]
    assert dup["passed"] is False and dup["actual"] == 7.0


def test_null_ids_count_once_like_distinct(spark):
    # distinct() counts all null ids as one value.
    rows = [shipment(shipment_id=None), shipment(shipment_id=None), shipment(shipment_id=1)]
    dup = _checks(spark, rows)["No duplicate shipment IDs"]
    assert dup["actual"] == 1.0


def test_null_status_not_counted_as_invalid(spark):
    # T8: ~isin skips null; the null is caught by the null check instead.
    rows = [shipment(shipment_id=1, status=None), shipment(shipment_id=2, status="LOST")]
    got = _checks(spark, rows)
    assert got["All status values are valid"]["actual"] == 1.0
    assert got["No nulls in status"]["actual"] == 1.0


def test_empty_table_weight_check_fails_without_error(spark):
    # T7: min over no rows is null; the check fails instead of raising.
    got = _checks(spark, [])
    assert got["All weights are positive"]["passed"] is False
    assert got["All weights are positive"]["actual"] is None
    assert got["Minimum row count >= 50"]["passed"] is False


def test_checks_before_filter_see_fail_rows(spark):
    # T3: run on any frame, also before the PASS filter.
    rows = [shipment(shipment_id=1, weight_kg=-2.0), shipment(shipment_id=2, status="x")]
    got = _checks(spark, rows)
    assert got["All DQ flags are PASS"]["actual"] == 2.0
    assert got["All weights are positive"]["passed"] is False


def test_tally_and_gate(spark):
    rows = [shipment(shipment_id=i) for i in range(10)]
    checks = quality.silver_checks(silver.flagged(frame(spark, rows)))
    t = quality.check_tally(checks).collect()[0]
    assert (t["total"], t["passed"], t["failed"]) == (9, 8, 1)
    assert [r["check_name"] for r in quality.gate(checks, "warn")] == ["Minimum row count >= 50"]
    with pytest.raises(quality.QualityGateError):
        quality.gate(checks, "raise")


@pytest.fixture(scope="module")
def oltp_tables(spark):
    suppliers = spark.createDataFrame(
        [(1, "Acme", "1.5"), (2, None, "12.5"), (2, "Dup", "5.999"), (None, "NoKey", None)],
        "supplier_id long, supplier_name string, rating string",
    )
    products = spark.createDataFrame(
        [(10, "P10", 1), (11, "P11", 3), (12, "P12", None), (13, "A product name", 3)],
        "product_id long, product_name string, supplier_id long",
    )
    return {"suppliers": suppliers, "products": products}


def test_pk_and_not_null(oltp_tables):
    pk = {r["constraint_name"]: r["n"] for r in quality.pk_violations(oltp_tables).collect() if r["n"] is not None}
    # one duplicate of id 2 and one null key
    assert pk == {"suppliers.supplier_id": 2, "products.product_id": 0}
    nn = {r["constraint_name"]: r["n"] for r in quality.not_null_violations(oltp_tables).collect() if r["n"] is not None}
    assert nn == {"suppliers.supplier_name": 1, "products.product_name": 0}


def test_fk_orphans_count_rows_and_allow_null(oltp_tables):
    fk = {r["constraint_name"]: r["n"] for r in quality.fk_orphans(oltp_tables).collect() if r["n"] is not None}
    # supplier 3 is missing twice; a null key is allowed
    assert fk == {"products.supplier_id -> suppliers.supplier_id": 2}


def test_fk_orphans_hot_key(spark):
    child = spark.range(0, 3000).select((F.col("id") % 2 * 99).alias("fk"))  # half the rows on 99
    parent = spark.range(0, 10).select(F.col("id").alias("pk"))
    n = quality.orphan_count(child, "fk", parent, "pk").collect()[0]["n"]
    assert n == 1500


def test_length_and_decimal(oltp_tables):
    lv = {
        r["constraint_name"]: r["n"]
        for r in quality.length_violations(oltp_tables, [("products", "product_name", 4)]).collect()
    }
    assert lv == {"products.product_name": 1}
    dv = {r["constraint_name"]: r["n"] for r in quality.decimal_violations(oltp_tables).collect() if r["n"] is not None}
    # '12.5' overflows DECIMAL(3,2); '5.999' rounds to 6.00 and fits.
    assert dv == {"suppliers.rating decimal(3,2)": 1}


def test_defaults_fill_omitted_columns_only(spark):
    ts = F.lit("2026-01-01 00:00:00").cast("timestamp")
    omitted = spark.createDataFrame([(1, 5, "WH-1", 10)], "inventory_id int, product_id int, warehouse_id string, quantity int")
    r = quality.apply_defaults(omitted, "inventory", ts).collect()[0]
    assert r["reorder_level"] == 100 and r["last_updated"] is not None
    present = spark.createDataFrame([(1, None)], "inventory_id int, reorder_level int")
    r2 = quality.apply_defaults(present, "inventory", ts).collect()[0]
    assert r2["reorder_level"] is None
    orders = quality.apply_defaults(spark.createDataFrame([(1,)], "order_id int"), "orders", ts)
    assert orders.collect()[0]["order_status"] == "PENDING"
    ships = quality.apply_defaults(spark.createDataFrame([(1,)], "shipment_id int"), "shipments", ts)
    assert ships.collect()[0]["status"] == "IN_TRANSIT"
    sup = quality.apply_defaults(spark.createDataFrame([(1,)], "supplier_id int"), "suppliers", ts)
    assert sup.collect()[0]["is_active"] is True
