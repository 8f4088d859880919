from cargolens import schemas as S


def shipment(**kw):
    """One bronze event with sensible defaults; override any field."""
    row = {
        "shipment_id": 1,
        "order_id": 1000,
        "product": "Laptop",
        "carrier": "DHL",
        "tracking_number": "TRK123456",
        "status": "IN_TRANSIT",
        "origin": "Mumbai",
        "destination": "Pune",
        "quantity": 1,
        "weight_kg": 5.0,
        "shipped_at": "2026-05-13T10:00:00",
        "delivered_at": None,
        "event_timestamp": "2026-05-13T10:00:00",
    }
    row.update(kw)
    return tuple(row[c] for c in S.SHIPMENT_COLUMNS)


def frame(spark, rows):
    return spark.createDataFrame(rows, S.SHIPMENT)
