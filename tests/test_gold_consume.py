"""Gold KPIs on hand rows, and the consumption layer on the gold rows the
reference logged for its 100-event run (golden values)."""

import pytest
from pyspark.sql import functions as F

from cargolens.operators import consume, gold, silver
from tests.helpers import frame, shipment

CARRIER = [
    ("Delhivery", 22, 6, 4, 26.84818181818182, 27.27),
    ("DTDC", 14, 3, 2, 21.997142857142855, 21.43),
    ("FedEx", 19, 4, 5, 26.403157894736843, 21.05),
    ("DHL", 15, 3, 2, 22.094666666666665, 20.0),
    ("Blue Dart", 30, 5, 6, 26.021666666666665, 16.67),
]
STATUS = [
    ("DELAYED", 21, 21),
    ("DELIVERED", 19, 19),
    ("OUT_FOR_DELIVERY", 17, 17),
    ("ORDER_PLACED", 13, 13),
    ("SHIPPED", 12, 12),
    ("PROCESSING", 10, 10),
    ("IN_TRANSIT", 8, 8),
]
PRODUCT = [
    ("Phone", 26, 153, 4, 15.38, 26.482692307692307),
    ("Camera", 16, 81, 5, 31.25, 24.11125),
    ("Monitor", 15, 74, 2, 13.33, 30.901333333333334),
    ("Laptop", 14, 66, 2, 14.29, 25.883571428571425),
    ("Headphones", 11, 60, 2, 18.18, 19.911818181818184),
    ("Tablet", 9, 50, 4, 44.44, 20.915555555555553),
    ("Keyboard", 9, 42, 2, 22.22, 22.76222222222222),
]
ROUTE = [
    ("Delhi", "Pune", 2, 1, 50.0, 34.46),
    ("Hyderabad", "Jaipur", 5, 2, 40.0, 31.068),
    ("Mumbai", "Ahmedabad", 5, 2, 40.0, 19.778),
    ("Bengaluru", "Lucknow", 6, 2, 33.33, 22.409999999999997),
    ("Mumbai", "Lucknow", 3, 1, 33.33, 21.180000000000003),
]


@pytest.fixture(scope="module")
def logged_gold(spark):
    return {
        "carrier_performance": spark.createDataFrame(
            CARRIER,
            "carrier string, total_shipments long, delayed_shipments long, delivered_shipments long, "
            "avg_weight_kg double, delay_rate_pct double",
        ),
        "shipment_status_summary": spark.createDataFrame(
            STATUS, "status string, total_shipments long, unique_orders long"
        ),
        "product_summary": spark.createDataFrame(
            PRODUCT,
            "product string, total_shipments long, total_quantity long, delayed_shipments long, "
            "delay_rate_pct double, avg_weight_kg double",
        ),
        "route_analysis": spark.createDataFrame(
            ROUTE,
            "origin string, destination string, total_shipments long, delayed_shipments long, "
            "delay_rate_pct double, avg_weight_kg double",
        ),
    }


def test_kpi_cards_golden(logged_gold):
    r = consume.kpi_cards(logged_gold["carrier_performance"]).collect()[0]
    assert (r["total_shipments"], r["total_delivered"], r["total_delayed"]) == (100, 19, 21)
    # T13: the dashboard's average is the unweighted mean of the rates.
    assert r["avg_delay_rate"] == 21.3
    assert r["weighted_delay_rate"] == 21.0
    assert r["band"] == "red"


def test_business_questions_golden(logged_gold):
    got = {
        r["question_id"]: (r["answer_key"], r["answer_value"])
        for r in consume.business_questions(logged_gold).collect()
    }
    assert got == {
        1: ("Delhivery", 27.27),
        2: ("IN_TRANSIT", 8.0),
        3: ("Phone", 26.0),
        4: ("Delhi → Pune", 50.0),
        5: ("DELIVERED", 19.0),
    }


def test_weekly_summary_golden(logged_gold):
    got = {r["point"]: (r["key"], r["value"]) for r in consume.weekly_summary(logged_gold).collect()}
    assert got == {
        1: ("all carriers", 21.0),
        2: ("Blue Dart", 16.67),
        3: ("Delhivery", 27.27),
        4: ("Delhi → Pune", 50.0),
        5: ("Phone", 26.0),
    }


def test_top_routes_explicit_order(logged_gold):
    # T11/T12: ties at 40.0 and 33.33 are broken by the route keys.
    rows = consume.top_delayed_routes(logged_gold["route_analysis"], 5).collect()
    assert [(r["origin"], r["destination"]) for r in rows] == [
        ("Delhi", "Pune"),
        ("Hyderabad", "Jaipur"),
        ("Mumbai", "Ahmedabad"),
        ("Bengaluru", "Lucknow"),
        ("Mumbai", "Lucknow"),
    ]
    top = consume.top_routes(logged_gold["route_analysis"], 2).collect()
    assert [r["route"] for r in top] == ["Delhi → Pune", "Hyderabad → Jaipur"]


def test_sorted_views(logged_gold):
    c = logged_gold["carrier_performance"]
    assert [r["carrier"] for r in consume.carriers_by_rate(c).collect()][0] == "Blue Dart"
    assert [r["carrier"] for r in consume.carriers_by_volume(c).collect()][0] == "Blue Dart"
    top = consume.top_products(logged_gold["product_summary"], 3).collect()
    assert [r["product"] for r in top] == ["Phone", "Camera", "Monitor"]


def test_status_share_sums_to_one(logged_gold):
    rows = consume.status_share(logged_gold["shipment_status_summary"]).collect()
    assert abs(sum(r["share"] for r in rows) - 1.0) < 1e-12
    assert {r["status"]: r["share"] for r in rows}["DELAYED"] == 0.21


def test_kpi_report_text(logged_gold, spark):
    report = consume.kpi_report(logged_gold)
    ordered = report.orderBy("section_no", F.col("k1").desc_nulls_last(), "k2", "k3", "sub")
    lines = [r["line"] for r in ordered.collect()]
    assert lines[0] == "CARRIER PERFORMANCE DATA"
    assert lines[1:7] == [
        "Carrier: Delhivery",
        "- Total Shipments: 22",
        "- Delayed: 6",
        "- Delivered: 4",
        "- Delay Rate: 27.27%",
        "- Avg Weight: 26.85 kg",
    ]
    assert "Status DELAYED: 21 shipments" in lines
    assert "Delhi → Pune: 50.0% delay rate" in lines
    assert "Phone: 26 shipments, 15.38% delay rate" in lines
    assert len(lines) == 4 + 5 * 6 + 7 + 5 + 7

    from cargolens.sinks.files import write_text_report

    from cargolens.session import scratch_path

    out = scratch_path(spark, "report")
    write_text_report(report, out)
    from cargolens.sinks.files import read_text_parts

    written = read_text_parts(spark, out).collect()
    assert [r["value"] for r in written] == lines


def test_display_projections(logged_gold):
    assert consume.carrier_detail(logged_gold["carrier_performance"]).columns == [
        "carrier", "total_shipments", "delivered_shipments", "delayed_shipments",
        "delay_rate_pct", "avg_weight_kg",
    ]
    rd = consume.route_detail(logged_gold["route_analysis"]).collect()
    assert rd[0]["route"] == "Delhi → Pune"


def test_route_label_is_null_when_a_side_is_null(spark):
    df = spark.createDataFrame([("A", None)], "origin string, destination string")
    assert consume.with_route(df).collect()[0]["route"] is None


def _silver_of(spark, rows):
    return silver.silver(frame(spark, rows))


def test_carrier_performance_values(spark):
    rows = [
        shipment(shipment_id=1, carrier="DHL", status="DELAYED", weight_kg=10.0),
        shipment(shipment_id=2, carrier="DHL", status="DELIVERED", weight_kg=20.0),
        shipment(shipment_id=3, carrier="DHL", status="SHIPPED", weight_kg=30.0),
        shipment(shipment_id=4, carrier="DHL", status="DELAYED", weight_kg=40.0),
        shipment(shipment_id=5, carrier="FedEx", status="SHIPPED", weight_kg=1.0),
    ]
    out = {r["carrier"]: r for r in gold.carrier_performance(_silver_of(spark, rows)).collect()}
    d = out["DHL"]
    assert (d["total_shipments"], d["delayed_shipments"], d["delivered_shipments"]) == (4, 2, 1)
    assert d["avg_weight_kg"] == 25.0 and d["delay_rate_pct"] == 50.0
    assert out["FedEx"]["delay_rate_pct"] == 0.0


def test_rate_is_null_when_all_ids_are_null(spark):
    # T10: count(shipment_id) is 0 for a group of null ids -> null, not an error.
    rows = [shipment(shipment_id=None, carrier="X", status="DELAYED")]
    r = gold.carrier_performance(_silver_of(spark, rows)).collect()[0]
    assert r["total_shipments"] == 0 and r["delay_rate_pct"] is None


def test_status_summary_distinct_orders(spark):
    rows = [
        shipment(shipment_id=1, order_id=7, status="SHIPPED"),
        shipment(shipment_id=2, order_id=7, status="SHIPPED"),
        shipment(shipment_id=3, order_id=8, status="SHIPPED"),
    ]
    r = gold.shipment_status_summary(_silver_of(spark, rows)).collect()[0]
    assert (r["total_shipments"], r["unique_orders"]) == (3, 2)


def test_product_summary_quantity(spark):
    rows = [
        shipment(shipment_id=1, product="Phone", quantity=3),
        shipment(shipment_id=2, product="Phone", quantity=4, status="DELAYED"),
    ]
    r = gold.product_summary(_silver_of(spark, rows)).collect()[0]
    assert (r["total_quantity"], r["delayed_shipments"], r["delay_rate_pct"]) == (7, 1, 50.0)


def test_card_labels_format_numbers(spark):
    cards = spark.createDataFrame(
        [(1234567, 19, 21, 21.3, "red")],
        "total_shipments long, total_delivered long, total_delayed long, avg_delay_rate double, band string",
    )
    r = consume.card_labels(cards).collect()[0]
    assert r["total_shipments"] == "1,234,567" and r["avg_delay_rate"] == "21.3%"


def test_bounded_copy_to_pandas(logged_gold):
    from cargolens.sinks.console import TooManyRowsError, to_pandas_bounded

    assert len(to_pandas_bounded(logged_gold["carrier_performance"], 5)) == 5
    with pytest.raises(TooManyRowsError):
        to_pandas_bounded(logged_gold["carrier_performance"], 4)


def test_kpi_cube_equals_separate_aggregates(spark, sf_small):
    from cargolens.plans.catalog import silver_shipments_df

    sv = silver_shipments_df(spark, sf_small)
    cube = gold.kpi_tables(sv)
    separate = gold.gold_tables(sv)
    for name, table in cube.items():
        cols = table.columns
        want = separate[name].select(*cols)
        assert table.exceptAll(want).count() == 0, name
        assert want.exceptAll(table).count() == 0, name
