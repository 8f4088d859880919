"""The silver checks as a gate on every micro-batch (Q1, STR5).

A batch is validated and written once, into a folder of its own below
``<out>_held``; the counts behind the checks are observed on that same write,
so the gate costs no further pass but the distinct count of ids. A batch that
passes is moved into the table as a whole (one rename); a batch that fails
stays held, with its reasons, and with ``on_fail="raise"`` the stream stops
there. The next start finds the same batch first, so nothing is passed over:
mend the source, or run with ``on_fail="warn"`` to let it through.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens import schemas as S
from cargolens.operators import quality, silver
from cargolens.session import move_path, write_text
from cargolens.streaming.jobs import _drain


def gated_silver_stream(
    bronze: DataFrame,
    out_path: str,
    checkpoint: str,
    run_ts: Column | None = None,
    on_fail: str = "raise",
    min_rows: int = S.MIN_ROW_COUNT,
) -> StreamingQuery:
    """Silver on a stream, batch by batch through the nine checks.

    The checks see the batch's PASS rows, as a batch run's checks see silver.
    Each batch's results are kept as ``<out>_checks/<batch>.json``."""
    base = out_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held, place = f"{base}_held/batch={batch_id}", f"{base}/batch={batch_id}"
        rows = silver.with_reasons(silver.flagged(batch, run_ts))
        extra = [S.CORRUPT_RECORD] if S.CORRUPT_RECORD in rows.columns else []
        rows = rows.select(*S.SILVER_COLUMNS, *extra, "reasons")
        observed = Observation(f"checks_{batch_id}")
        # the counts are those of the PASS rows: a FAIL row counts as no row
        is_pass = F.col("dq_flag") == F.lit(S.PASS)
        rows.observe(observed, *quality.check_stats(is_pass)).write.mode("overwrite").partitionBy("dq_flag").parquet(held)
        stats = observed.get
        written = spark.read.schema(rows.schema).parquet(held)
        ids = silver.passed(written).agg(F.count_distinct("shipment_id").alias("distinct_ids"))
        counts = ids.select(*[F.lit(stats[c]).alias(c) for c in quality.CHECK_STATS], "distinct_ids")
        checks = quality.check_rows(counts, min_rows).collect()  # nine rows
        text = json.dumps([r.asDict() for r in checks])
        write_text(spark, f"{base}_checks/{batch_id:012d}.json", text)
        failed = [r["check_name"] for r in checks if not r["passed"]]
        if failed and on_fail == "raise":
            raise quality.QualityGateError(f"batch {batch_id}: {', '.join(failed)}")
        move_path(spark, held, place)

    return _drain(bronze, checkpoint, write_batch)
