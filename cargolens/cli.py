"""Command line: the reference's jobs as subcommands on one library.

    python -m cargolens.cli land   --source <events dir> --bronze <root>
    python -m cargolens.cli land   --kafka-bootstrap <host:port> --topic <t> --bronze <root>
    python -m cargolens.cli silver --bronze <root> --lake <root> [--start D] [--end D] [--layout arrays]
    python -m cargolens.cli checks --lake <root> [--on-fail warn|raise]
    python -m cargolens.cli constraints --operational <root> | --jdbc-url <url> [--out <path>]
    python -m cargolens.cli publish --bronze <root> --kafka-bootstrap <host:port> --topic <t>
    python -m cargolens.cli gold   --lake <root>
    python -m cargolens.cli report --lake <root> --out <path>
    python -m cargolens.cli run    --bronze <root> --lake <root> [--on-fail raise]

On a cluster, submit with spark-submit and leave --master unset. Every
command reads what the previous one wrote (lineage is cut at each layer).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators import consume, gold, quality
from cargolens.plans import incremental, medallion
from cargolens.session import build_session
from cargolens.sinks import files, publish
from cargolens.sources import bronze, events, operational, tables


def _session(args):
    return build_session(app_name=f"cargolens-{args.command}", master=args.master)


def cmd_land(spark, args):
    """Drain new events into bronze: from a Kafka topic (decoded) or from a
    folder of event files. Values and lines that do not parse go to quarantine."""
    from cargolens.streaming import jobs, message_log

    # The checkpoint belongs to this landing (one per destination), hidden
    # under the bronze root, so a restart resumes exactly where it stopped.
    checkpoint = args.checkpoint or f"{args.bronze.rstrip('/')}/_landing_checkpoint"
    quarantine = args.quarantine or f"{args.bronze.rstrip('/')}_quarantine"
    if args.kafka_bootstrap or args.topic_folder:
        if args.topic_folder:
            messages = message_log.topic_stream(spark, args.topic_folder)
        else:
            messages = events.kafka_stream(
                spark, args.kafka_bootstrap, args.topic, max_offsets_per_trigger=args.messages_per_trigger
            )
        jobs.land_messages(
            messages.select("key", "value"), args.bronze, quarantine, checkpoint, max_records_per_file=args.records_per_file
        )
    else:
        source = events.file_stream(spark, args.source, S.SHIPMENT_WITH_CORRUPT, args.source_format)
        jobs.land_stream(source, args.bronze, checkpoint, args.records_per_file, quarantine)
    return {"bronze": args.bronze, "quarantine": quarantine}


def cmd_silver(spark, args):
    if args.incremental:
        done = incremental.run_silver(
            spark, args.bronze, args.lake, None, args.start, args.end, args.again, args.format
        )
        return {"dq_counts": {k: done[k] for k in ("pass", "fail")}, "landings": done["landings"]}
    counts = medallion.run_silver(
        spark, args.bronze, args.lake, None, args.start, args.end, args.format, args.layout
    )
    return {"dq_counts": counts}


def cmd_checks(spark, args):
    checks = quality.silver_checks(tables.read_silver(spark, args.lake, args.format))
    files.write_table(checks, args.lake, "checks", args.format)
    written = tables.read_layer_table(spark, args.lake, "checks", args.format)
    written.show(truncate=False)
    failed = quality.gate(written, args.on_fail)
    return {"failed_checks": [r["check_name"] for r in failed]}


def cmd_constraints(spark, args):
    """The declared constraints over the operational tables (JDBC url from
    --jdbc-url, or Parquet folders under --operational)."""
    frames = {
        t: operational.read_raw(spark, t, args.operational, args.jdbc_url) for t in S.OPERATIONAL_SCHEMAS
    }
    report = quality.constraint_report(frames)
    if args.out:
        report.write.mode("overwrite").format(args.format).save(args.out)
        report = spark.read.format(args.format).load(args.out)
    report.show(100, truncate=False)  # one row per declared rule
    return {"constraints": args.out or "shown"}


def cmd_publish(spark, args):
    """Publish bronze events to a topic or a topic folder, keyed by order."""
    from cargolens.streaming import message_log

    rows = bronze.LAYOUTS[args.layout](spark, args.bronze, args.start, args.end)
    good = rows.filter(F.col(S.CORRUPT_RECORD).isNull()).select(*S.SHIPMENT_COLUMNS)
    if args.topic_folder:
        payload = publish.shipment_payload(good, "event_timestamp")
        message_log.publish_batch(payload, args.topic_folder, args.partitions, "event_timestamp")
        return {"topic": args.topic_folder}
    publish.publish_kafka(publish.shipment_payload(good), args.kafka_bootstrap, args.topic)
    return {"topic": args.topic}


def cmd_gold(spark, args):
    sv = tables.read_silver(spark, args.lake, args.format)
    for name, table in gold.gold_tables(sv, run_ts=F.current_timestamp()).items():
        files.write_table(table, args.lake, name, args.format)
    return {"gold": list(gold.GOLD_TABLES)}


def cmd_report(spark, args):
    """The text context, the weekly summary and the answers, from stored gold."""
    g = tables.read_gold(spark, args.lake, args.format)
    files.write_text_report(consume.kpi_report(g), args.out)
    for name, df in (("business_questions", consume.business_questions(g)), ("weekly_summary", consume.weekly_summary(g))):
        path = f"{args.out.rstrip('/')}_{name}"
        df.write.mode("overwrite").json(path)
        spark.read.json(path).show(truncate=False)
    return {"report": args.out}


def cmd_run(spark, args):
    if args.incremental:
        return incremental.run_incremental(
            spark, args.bronze, args.lake, F.current_timestamp(), args.on_fail, args.start, args.end, args.again, args.format
        )
    return medallion.run_medallion(
        spark,
        args.bronze,
        args.lake,
        on_fail=args.on_fail,
        start=args.start,
        end=args.end,
        fmt=args.format,
        layout=args.layout,
    )


COMMANDS = {
    "land": cmd_land,
    "silver": cmd_silver,
    "checks": cmd_checks,
    "constraints": cmd_constraints,
    "publish": cmd_publish,
    "gold": cmd_gold,
    "report": cmd_report,
    "run": cmd_run,
}


def parse(argv=None):
    p = argparse.ArgumentParser(prog="cargolens")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--master", default=None, help="only for local runs, e.g. local[*]")
    p.add_argument("--source")
    p.add_argument("--kafka-bootstrap", help="read a topic instead of a folder (needs the Kafka package)")
    p.add_argument("--topic", default="shipment-events")
    p.add_argument("--topic-folder", help="land, publish: a topic of message files instead of a broker")
    p.add_argument("--partitions", type=int, default=8, help="partitions of a topic folder")
    p.add_argument("--quarantine")
    p.add_argument("--source-format", default="json")
    p.add_argument("--bronze")
    p.add_argument("--lake")
    p.add_argument("--out")
    p.add_argument("--checkpoint")
    p.add_argument("--start", help="first ingest day (yyyy-MM-dd); open when not given")
    p.add_argument("--end", help="last ingest day; open when not given")
    p.add_argument("--incremental", action="store_true", help="silver, run: only landings that no run has processed")
    p.add_argument("--again", action="store_true", help="with --incremental: the given days' landings once more")
    p.add_argument("--layout", default="lines", choices=sorted(bronze.LAYOUTS), help="bronze layout to read")
    p.add_argument("--format", default="parquet", help="table format of silver and gold, e.g. delta")
    p.add_argument("--operational", help="root of the operational tables as Parquet")
    p.add_argument("--jdbc-url")
    p.add_argument("--records-per-file", type=int, default=S.FILE_RECORDS, help="10 gives a consumer's small files")
    p.add_argument("--messages-per-trigger", type=int, default=S.MESSAGES_PER_TRIGGER)
    p.add_argument("--on-fail", default="warn", choices=["warn", "raise"])
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse(argv)
    spark = _session(args)
    try:
        result = COMMANDS[args.command](spark, args)
    except quality.QualityGateError as e:
        print(json.dumps({"error": str(e)}))
        return 2
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
