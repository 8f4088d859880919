"""Keyed publish (SNK5): key = order id as text, value = the event as JSON.

Messages with one key go to one topic partition, which keeps per-order
ordering. Writing to a broker needs the Kafka package and a configured
``kafka.bootstrap.servers``; without them the payload frame is still built
and can be inspected or written to files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cargolens import schemas as S
from cargolens.sources.events import as_messages


def shipment_payload(events: DataFrame, *keep: str) -> DataFrame:
    """(key, value) for shipment events, keyed by order_id, and the columns to keep beside them."""
    cols = [c for c in S.SHIPMENT_COLUMNS if c in events.columns]
    return as_messages(events, "order_id", cols, keep)


def publish_kafka(payload: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Batch write of the payload to a topic."""
    (
        payload.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
