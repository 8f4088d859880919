"""Queries of the later milestones (checks, consumption, I/O, streaming)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cargolens import session as SS
from cargolens.operators import consume, gold, quality, silver
from cargolens.plans import fixtures, medallion
from cargolens.plans.catalog import SILVER_OUT, flagged_shipments, register, silver_shipments_df
from cargolens.sinks import files, publish
from cargolens.sources import bronze, tables
from cargolens.sources import events as EV
from cargolens.streaming import dedup, jobs

RUN_TIMESTAMP = "2026-01-01 00:00:00"


def run_ts():
    """One fixed stamp for reproducible runs (built lazily: needs a session)."""
    return F.lit(RUN_TIMESTAMP).cast("timestamp")


# --- milestone 3: silver checks, DDL constraints -----------------------------


@register("dq_checks")
def q_dq_checks(spark, sf_dir):
    return quality.silver_checks(silver_shipments_df(spark, sf_dir))


@register("dq_tally")
def q_dq_tally(spark, sf_dir):
    return quality.check_tally(quality.silver_checks(silver_shipments_df(spark, sf_dir)))


@register("pk_violations")
def q_pk_violations(spark, sf_dir):
    return quality.pk_violations(fixtures.operational_tables(spark, sf_dir))


@register("not_null_violations")
def q_not_null_violations(spark, sf_dir):
    return quality.not_null_violations(fixtures.operational_tables(spark, sf_dir))


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    return quality.fk_orphans(fixtures.operational_tables(spark, sf_dir))


@register("length_violations")
def q_length_violations(spark, sf_dir):
    return quality.length_violations(fixtures.operational_tables(spark, sf_dir))


@register("decimal_violations")
def q_decimal_violations(spark, sf_dir):
    return quality.decimal_violations(fixtures.operational_tables(spark, sf_dir))


@register("dq_checks_flagged")
def q_dq_checks_flagged(spark, sf_dir):
    """The same checks before the PASS filter, where every one can fail."""
    return quality.silver_checks(flagged_shipments(spark, sf_dir))


@register("cast_violations")
def q_cast_violations(spark, sf_dir):
    return quality.cast_violations(fixtures.operational_tables(spark, sf_dir))


@register("apply_defaults")
def q_apply_defaults(spark, sf_dir):
    """Defaults of all five tables: an insert that omits a column gets its
    default in every row; where the column is present, its nulls are kept."""
    tables = fixtures.operational_tables(spark, sf_dir)
    frames = []

    def case(table, column, omitted, filled):
        df = quality.apply_defaults(tables[table].drop(column) if omitted else tables[table], table, run_ts())
        name = f"{table}.{column} {'omitted' if omitted else 'present'}"
        frames.append(
            df.agg(F.count("*").alias("n"), F.count_if(filled).alias("filled")).select(
                F.lit(name).alias("case_name"), "n", "filled"
            )
        )

    case("inventory", "reorder_level", True, F.col("reorder_level") == 100)
    case("inventory", "reorder_level", False, F.col("reorder_level").isNotNull())
    case("inventory", "last_updated", True, F.col("last_updated") == run_ts())
    case("suppliers", "is_active", True, F.col("is_active"))
    case("suppliers", "created_at", True, F.col("created_at") == run_ts())
    case("products", "created_at", True, F.col("created_at") == run_ts())
    case("orders", "order_status", True, F.col("order_status") == "PENDING")
    case("orders", "order_date", True, F.col("order_date") == run_ts())
    case("shipments", "status", True, F.col("status") == "IN_TRANSIT")
    case("shipments", "status", False, F.col("status") == "IN_TRANSIT")
    case("shipments", "shipped_at", True, F.col("shipped_at") == run_ts())
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- milestone 5: consumption -------------------------------------------------


def gold_of(spark, sf_dir):
    return gold.gold_tables(silver_shipments_df(spark, sf_dir))


def kpis_of(spark, sf_dir):
    """All four KPI tables from one pass (for consumers of several tables)."""
    return gold.kpi_tables(silver_shipments_df(spark, sf_dir))


@register("carrier_detail")
def q_carrier_detail(spark, sf_dir):
    return consume.carrier_detail(gold_of(spark, sf_dir)["carrier_performance"])


@register("product_detail")
def q_product_detail(spark, sf_dir):
    return consume.product_detail(gold_of(spark, sf_dir)["product_summary"])


@register("route_detail")
def q_route_detail(spark, sf_dir):
    return consume.route_detail(gold_of(spark, sf_dir)["route_analysis"])


@register("carriers_by_rate")
def q_carriers_by_rate(spark, sf_dir):
    return consume.carriers_by_rate(gold_of(spark, sf_dir)["carrier_performance"])


@register("carriers_by_volume")
def q_carriers_by_volume(spark, sf_dir):
    return consume.carriers_by_volume(gold_of(spark, sf_dir)["carrier_performance"])


@register("top_products")
def q_top_products(spark, sf_dir):
    return consume.top_products(gold_of(spark, sf_dir)["product_summary"], 10)


@register("top_routes")
def q_top_routes(spark, sf_dir):
    return consume.top_routes(gold_of(spark, sf_dir)["route_analysis"], 10)


@register("top5_delayed_routes")
def q_top5_delayed_routes(spark, sf_dir):
    return consume.top_delayed_routes(gold_of(spark, sf_dir)["route_analysis"], 5)


@register("status_share")
def q_status_share(spark, sf_dir):
    return consume.status_share(gold_of(spark, sf_dir)["shipment_status_summary"])


@register("kpi_cards")
def q_kpi_cards(spark, sf_dir):
    return consume.kpi_cards(gold_of(spark, sf_dir)["carrier_performance"])


@register("business_questions")
def q_business_questions(spark, sf_dir):
    return consume.business_questions(kpis_of(spark, sf_dir))


@register("weekly_summary")
def q_weekly_summary(spark, sf_dir):
    return consume.weekly_summary(kpis_of(spark, sf_dir))


@register("kpi_report")
def q_kpi_report(spark, sf_dir):
    """The report as written: gold stored, read back, lines in file order."""
    base = SS.scratch_path(spark, "report")
    for name, table in kpis_of(spark, sf_dir).items():
        files.write_table(table, base, name)
    stored = {name: tables.read_layer_table(spark, base, name) for name in gold.GOLD_TABLES}
    files.write_text_report(consume.kpi_report(stored), f"{base}/text")
    lines = files.read_text_parts(spark, f"{base}/text")
    return lines.select(F.col("pos"), F.col("value").alias("line"))


@register("kpi_cards_text")
def q_kpi_cards_text(spark, sf_dir):
    return consume.card_labels(consume.kpi_cards(gold_of(spark, sf_dir)["carrier_performance"]))


@register("gold_order")
def q_gold_order(spark, sf_dir):
    """The rows of each KPI table with their place in its sort order."""
    g = gold_of(spark, sf_dir)
    route = F.concat("origin", F.lit(fixtures.S.ROUTE_SEPARATOR), "destination")
    keys = {
        "carrier_performance": F.col("carrier"),
        "shipment_status_summary": F.col("status"),
        "route_analysis": route,
        "product_summary": F.col("product"),
    }
    frames = [in_order(g[name]).select(F.lit(name).alias("table_name"), "pos", key.alias("key")) for name, key in keys.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def in_order(df):
    """A sorted table with each row's place: rows are numbered inside the
    ranges that the sort made, after the rows of earlier ranges."""
    base = SS.scratch_path(df.sparkSession, "ordered")
    part, row = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")
    df.select("*", part, row).write.parquet(base)
    ranged = df.sparkSession.read.parquet(base)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.join(sizes, "_part").withColumn("pos", F.col("_id") - F.col("_first") + F.col("_before") + 1)
    return placed.drop("_part", "_id", "_first", "_before")


# --- milestone 4: landing, readers, end-to-end run -------------------------------


BY_DATE_START, BY_DATE_END = "1996-03-01", "1996-03-31"


@register("bronze_by_date")
def q_bronze_by_date(spark, sf_dir):
    """Land the shipments by day, read back one month: folder pruning."""
    root = SS.scratch_path(spark, "bronze_by_date")
    medallion.land_partitioned(fixtures.raw_shipments(spark, sf_dir), root, by_event_date=True)
    month = bronze.read_bronze_by_date(spark, root, BY_DATE_START, BY_DATE_END)
    return month.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


def _writers(spark, stored):
    """The tasks to spread the rows of a stored table over before they are
    landed: a table of as many tasks needs no shuffle."""
    cores = SS.parallelism(spark)
    return cores if stored.rdd.getNumPartitions() < cores else None


@register("bronze_scan")
def q_bronze_scan(spark, sf_dir):
    """Land in the reference layout (JSON arrays of up to ten events per
    file) and scan it with the multiline reader: the rows come back whole."""
    root = SS.scratch_path(spark, "bronze_arrays")
    lines = tables.read_table(spark, sf_dir, "lineitem")
    files.land_json_arrays(fixtures.raw_shipments(spark, sf_dir), root, writers=_writers(spark, lines))
    good, _ = bronze.split_corrupt(bronze.read_bronze(spark, root, multiline=True, small=True))
    return good.select(*fixtures.S.SHIPMENT_COLUMNS)


@register("bronze_inventory")
def q_bronze_inventory(spark, sf_dir):
    """File listing of a landed bronze folder (path and length, content
    pruned), with the rows that those files hold."""
    root = SS.scratch_path(spark, "bronze_lines")
    files.land_json_lines(
        files.with_ingest_date(fixtures.raw_shipments(spark, sf_dir)),
        root,
        max_records_per_file=10_000,
    )
    listing = bronze.bronze_inventory(spark, root).agg(
        F.count("*").alias("files"), F.min("length").alias("least"), F.sum("length").alias("bytes")
    )
    rows = bronze.read_bronze_partitioned(spark, root).agg(F.count("*").alias("landed_rows"))
    # two one-row results side by side
    both = rows.unionByName(listing, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    full = (F.col("files") > 0) & (F.col("least") > 0) & (F.col("bytes") > F.col("landed_rows"))
    return both.select("landed_rows", full.alias("files_not_empty"))


@register("schema_report")
def q_schema_report(spark, sf_dir):
    return schema_profile(silver_shipments_df(spark, sf_dir).select(*fixtures.S.SILVER_COLUMNS))


def schema_profile(df):
    """(column_name, data_type, non_null): the schema of a table with the
    non-null count of each column, from one aggregate pass."""
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


@register("medallion_run")
def q_medallion_run(spark, sf_dir):
    """Land, then silver -> checks -> gold through written tables; report the
    rows of every table the run wrote and the values of the stored gold."""
    base = SS.scratch_path(spark, "medallion")
    bronze_root, out_root = f"{base}/bronze", f"{base}/lake"
    medallion.land_partitioned(fixtures.raw_shipments(spark, sf_dir), bronze_root)
    medallion.run_medallion(spark, bronze_root, out_root, run_ts=run_ts(), on_fail="warn")
    counts = medallion.layer_counts(spark, bronze_root, out_root).filter(~F.col("table_name").isin(*gold.GOLD_TABLES))
    out = counts.select("table_name", F.lit("").alias("key"), "n", F.lit(None).cast("double").alias("value"))
    return out.unionByName(gold_values(tables.read_gold(spark, out_root)))


def gold_values(stored):
    """(table_name, key, n, value): the measures of the stored gold tables."""
    out = None
    route = F.concat("origin", F.lit(fixtures.S.ROUTE_SEPARATOR), "destination")
    for table, name, key, n, value in [
        ("carrier_performance", "carrier_performance", F.col("carrier"), "total_shipments", "avg_weight_kg"),
        ("carrier_performance", "carrier_performance rate", F.col("carrier"), "delayed_shipments", "delay_rate_pct"),
        ("shipment_status_summary", "shipment_status_summary", F.col("status"), "total_shipments", "unique_orders"),
        ("route_analysis", "route_analysis", route, "total_shipments", "avg_weight_kg"),
        ("route_analysis", "route_analysis rate", route, "delayed_shipments", "delay_rate_pct"),
        ("product_summary", "product_summary", F.col("product"), "total_shipments", "avg_weight_kg"),
        ("product_summary", "product_summary rate", F.col("product"), "total_quantity", "delay_rate_pct"),
    ]:
        values = stored[table].select(
            F.lit(name).alias("table_name"), key.alias("key"), F.col(n).alias("n"), F.col(value).cast("double").alias("value")
        )
        out = values if out is None else out.unionByName(values)
    return out


@register("silver_two_days")
def q_silver_two_days(spark, sf_dir):
    """Two ingest days; the first is run, then everything from the second on,
    then the first again: each run replaces its own days only."""
    base = SS.scratch_path(spark, "two_days")
    _land_two_days(spark, sf_dir, f"{base}/bronze")
    for start, end in ((None, DAYS[0]), (DAYS[1], None), (DAYS[0], DAYS[0])):
        medallion.run_silver(spark, f"{base}/bronze", f"{base}/lake", run_ts(), start, end)
    stored = tables.read_layer_table(spark, f"{base}/lake", "shipments")
    day = F.col("ingest_date").cast("string").alias("ingest_date")
    return stored.groupBy(day, "dq_flag").agg(F.count("*").alias("n"))


DAYS = ("2026-01-01", "2026-01-02")


def _on_second_day():
    return F.col("shipment_id") % 3 == 0


def _land_two_days(spark, sf_dir, root):
    day = F.when(_on_second_day(), F.lit(DAYS[1])).otherwise(F.lit(DAYS[0]))
    files.land_json_lines(fixtures.raw_shipments(spark, sf_dir).withColumn("ingest_date", day), root)


@register("arrays_one_day")
def q_arrays_one_day(spark, sf_dir):
    """The reference layout end to end: JSON arrays in dated folders, silver
    of one day."""
    base = SS.scratch_path(spark, "arrays_days")
    raw = fixtures.stored_shipments(spark, sf_dir, f"{base}/shipments")
    writers = _writers(spark, raw)
    for day, rows in zip(DAYS, (raw.filter(~_on_second_day()), raw.filter(_on_second_day())), strict=True):
        files.land_json_arrays(rows, f"{base}/bronze", batch_size=1_000, writers=writers, day=day)
    medallion.run_silver(
        spark, f"{base}/bronze", f"{base}/lake", run_ts(), start=DAYS[1], layout="arrays"
    )
    stored = tables.read_layer_table(spark, f"{base}/lake", "shipments")
    return stored.groupBy("dq_flag").agg(F.count("*").alias("n"))


# --- milestone 6: streaming ------------------------------------------------------


STREAM_FILES_PER_TRIGGER = 32
INPUT_FILES = 96  # of the fixture's folder: three batches or more
INPUT_FILE_RECORDS = (2_000, 500_000)  # the least and most events of its files
FIXTURE_SPAN = "3000 days"  # the fixture's files hold its seven years in no order, so none of it is late


def _shipment_input(spark, sf_dir, base):
    """The fixture's shipments as JSON Lines files: the folder a file stream
    (or, on a cluster, a topic) delivers. Its files grow with the input up to a
    bound, so that a stream's batches do not stay small."""
    path = f"{base}/input"
    lines = tables.read_table(spark, sf_dir, "lineitem").count()  # from the file footers
    least, most = INPUT_FILE_RECORDS
    files.land_json_lines(
        fixtures.raw_shipments(spark, sf_dir),
        path,
        max_records_per_file=min(max(lines // INPUT_FILES, least), most),
        partition_by=None,
    )
    return path


def _shipment_stream(spark, path):
    return EV.file_stream(
        spark, path, fixtures.S.SHIPMENT, "json", max_files_per_trigger=STREAM_FILES_PER_TRIGGER
    )


@register("stream_source")
def q_stream_source(spark, sf_dir):
    """The events table read as a stream (drain, then stop) into a table."""
    base = SS.scratch_path(spark, "stream_source")
    source = EV.file_stream(
        spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema, "parquet", glob="events.parquet"
    )
    jobs.passthrough_stream(source, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type", "value")


@register("decode_events")
def q_decode_events(spark, sf_dir):
    """events -> (key, JSON value) messages, some cut short -> columns. A message
    that does not parse comes back too, with its key and text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    messages = EV.as_messages(events, "event_id", ["event_id", "user_id", "event_type", "value", "props"])
    text = F.col("value").cast("string")
    cut = F.col("key").cast("string").cast("long") % 997 == 3
    messages = messages.withColumn("value", F.when(cut, F.substring(text, 1, 12)).otherwise(text).cast("binary"))
    decoded = EV.decode(messages, EV.EVENT_SCHEMA, keep_raw=True)
    ok = F.col("_parsed_ok")
    fields = [F.when(ok, F.col(c)).alias(c) for c in ("event_id", "user_id", "event_type", "value")]
    return decoded.select(
        "key",
        ok.alias("parsed"),
        F.when(~ok, F.col("_raw")).alias("rejected"),
        *fields,
        F.when(ok, F.from_json("props", EV.PROPS_SCHEMA)["k"]).alias("prop_k"),
    )


@register("publish_payload")
def q_publish_payload(spark, sf_dir):
    """Keyed messages: the key as text, and the value decoded again."""
    payload = publish.shipment_payload(fixtures.raw_shipments(spark, sf_dir))
    value = F.from_json(F.col("value").cast("string"), fixtures.S.SHIPMENT).alias("m")
    return payload.select(F.col("key").cast("string").alias("key"), value).select("key", "m.*")


@register("stream_landing")
def q_stream_landing(spark, sf_dir):
    """Count-batched landing in files of ten: all rows, no file with more."""
    base = SS.scratch_path(spark, "stream_landing")
    src = _shipment_input(spark, sf_dir, base)
    jobs.land_stream(
        _shipment_stream(spark, src), f"{base}/bronze", f"{base}/checkpoint", fixtures.S.BRONZE_BATCH_SIZE
    )
    landed = bronze.read_small_lines(spark, f"{base}/bronze")
    per_file = landed.groupBy("file").agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("total"), (F.max("n") <= fixtures.S.BRONZE_BATCH_SIZE).alias("at_most_ten"))


def _broken():
    return F.col("shipment_id") % 1000 == 7


def _lines_with_broken(spark, sf_dir, stored=None):
    """The shipments as JSON text lines, some of which do not parse (``stored``:
    a path to keep the shipments at, where they are read several times)."""
    raw = fixtures.raw_shipments(spark, sf_dir) if stored is None else fixtures.stored_shipments(spark, sf_dir, stored)
    text = F.to_json(F.struct(*fixtures.S.SHIPMENT_COLUMNS))
    broken = F.concat(F.lit("broken { "), F.col("shipment_id").cast("string"))
    return raw.select("shipment_id", "order_id", F.when(_broken(), broken).otherwise(text).alias("value"))


def _places(spark, bronze_root, quarantine_root, *more):
    good = bronze.read_bronze_partitioned(spark, bronze_root).filter(F.col("shipment_id").isNotNull())
    bad = spark.read.schema("value STRING").json(quarantine_root)
    blank = [F.lit(None).cast("string").alias("first_text")] if more else []
    first = [F.min("value").alias("first_text")] if more else []
    out = good.agg(F.count("*").alias("n")).select(F.lit("bronze").alias("place"), "n", *blank)
    rejected = bad.agg(F.count("*").alias("n"), *first).select(F.lit("quarantine").alias("place"), "n", *more)
    return out.unionByName(rejected)


@register("landing_two_runs")
def q_landing_two_runs(spark, sf_dir):
    """Two topics landed into one root, each on its own checkpoint, the second
    beside a batch landing: nothing of any of them is lost or hidden."""
    base = SS.scratch_path(spark, "two_runs")
    lines = _lines_with_broken(spark, sf_dir, f"{base}/shipments")
    for i in range(3):
        part = lines.filter((F.col("shipment_id") % 3 == i))
        if i == 2:
            good = part.filter(~_broken()).select(F.from_json("value", fixtures.S.SHIPMENT).alias("m")).select("m.*")
            files.land_json_lines(files.with_ingest_date(good), f"{base}/bronze")
            part = part.filter(_broken())
        part.select(F.col("order_id").cast("string").alias("key"), "value").write.options(**files.PACKED).json(f"{base}/topic{i}")
        messages = EV.file_stream(spark, f"{base}/topic{i}", "key STRING, value STRING", "json").select(
            F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
        )
        jobs.land_messages(messages, f"{base}/bronze", f"{base}/quarantine", f"{base}/checkpoint{i}")
    return _places(spark, f"{base}/bronze", f"{base}/quarantine")


@register("landing_malformed")
def q_landing_malformed(spark, sf_dir):
    """File landing with lines that do not parse: they keep their text."""
    base = SS.scratch_path(spark, "landing_malformed")
    _lines_with_broken(spark, sf_dir).select("value").write.options(**files.PACKED).text(f"{base}/input")
    source = EV.file_stream(spark, f"{base}/input", fixtures.S.SHIPMENT_WITH_CORRUPT, "json")
    jobs.land_stream(source, f"{base}/bronze", f"{base}/checkpoint", quarantine_path=f"{base}/quarantine")
    return _places(spark, f"{base}/bronze", f"{base}/quarantine", "first_text")


@register("stream_restart")
def q_stream_restart(spark, sf_dir):
    """Run the landing twice on one checkpoint: the second run adds nothing."""
    base = SS.scratch_path(spark, "stream_restart")
    src = _shipment_input(spark, sf_dir, base)
    out, ckpt = f"{base}/bronze", f"{base}/checkpoint"
    seen = []
    for _ in range(2):
        jobs.land_stream(_shipment_stream(spark, src), out, ckpt)
        seen.append(spark.read.schema(fixtures.S.SHIPMENT).json(out).count())
    return spark.createDataFrame(
        [(1, seen[0]), (2, seen[1] - seen[0])], "run INT, new_rows BIGINT"
    )


@register("stream_silver")
def q_stream_silver(spark, sf_dir):
    """The silver rules on a stream; the result equals batch silver."""
    base = SS.scratch_path(spark, "stream_silver")
    src = _shipment_input(spark, sf_dir, base)
    jobs.silver_stream(_shipment_stream(spark, src), f"{base}/silver", f"{base}/checkpoint", run_ts())
    return silver.passed(spark.read.parquet(f"{base}/silver")).select(*SILVER_OUT)


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """The rows that the silver rules reject on a stream, with their reasons."""
    base = SS.scratch_path(spark, "stream_quarantine")
    src = _shipment_input(spark, sf_dir, base)
    jobs.silver_stream(_shipment_stream(spark, src), f"{base}/silver", f"{base}/checkpoint", run_ts())
    rejected = silver.failed(spark.read.parquet(f"{base}/silver"))
    return rejected.select("shipment_id", "status", "weight_kg", F.concat_ws(",", "reasons").alias("reasons"))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Shipment ids after the streaming dedup: each id once."""
    base = SS.scratch_path(spark, "stream_dedup")
    src = _shipment_input(spark, sf_dir, base)
    dedup.dedup_stream(_shipment_stream(spark, src), f"{base}/dedup", f"{base}/checkpoint", FIXTURE_SPAN)
    return spark.read.parquet(f"{base}/dedup").select("shipment_id")


@register("stream_dedup_outputs")
def q_stream_dedup_outputs(spark, sf_dir):
    """A second delivery that repeats all ids a day later, with rows without an
    id and rows far behind: repeats go, the others are kept in their own outputs."""
    base = SS.scratch_path(spark, "stream_dedup_outputs")
    raw = fixtures.stored_shipments(spark, sf_dir, f"{base}/shipments")
    step = F.col("shipment_id") % 50
    at = lambda text: raw.withColumn("event_timestamp", F.lit(text))
    first = at("2026-03-02T10:00:00").filter((step != 2) & (step != 1))
    times = F.when(step == 2, F.col("event_timestamp")).when(step == 1, F.lit("2026-01-01T00:00:00")).otherwise(F.lit("2026-03-03T09:00:00"))
    given = raw.filter(step.isNotNull())
    second = given.withColumns({"event_timestamp": times, "shipment_id": F.when(step != 2, F.col("shipment_id"))})
    for rows in (first, second):  # one drain per delivery
        files.land_json_lines(rows, f"{base}/input", partition_by=None)
        dedup.dedup_stream(_shipment_stream(spark, f"{base}/input"), f"{base}/dedup", f"{base}/checkpoint", "2 days")
    out = None
    for place, path in (("new", "dedup"), ("late", "dedup_late"), ("no_key", "dedup_no_key")):
        n = spark.read.schema(fixtures.S.SHIPMENT).parquet(f"{base}/{path}").agg(F.count("*").alias("n"))
        n = n.select(F.lit(place).alias("place"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@register("stream_messages")
def q_stream_messages(spark, sf_dir):
    """Shipments as keyed JSON messages, decoded on a stream and landed:
    every message comes back as the event it encoded."""
    base = SS.scratch_path(spark, "stream_messages")
    payload = publish.shipment_payload(fixtures.raw_shipments(spark, sf_dir))
    topic = payload.select(F.col("key").cast("string"), F.col("value").cast("string"))
    topic.write.options(**files.PACKED).option("maxRecordsPerFile", INPUT_FILE_RECORDS[1]).json(f"{base}/topic")
    messages = EV.file_stream(
        spark, f"{base}/topic", "key STRING, value STRING", "json",
        max_files_per_trigger=STREAM_FILES_PER_TRIGGER,
    ).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    jobs.land_messages(
        messages, f"{base}/bronze", f"{base}/quarantine", f"{base}/checkpoint",
        max_records_per_file=10_000,
    )
    landed = spark.read.schema(fixtures.S.SHIPMENT).json(f"{base}/bronze")
    return landed.select(*fixtures.S.SHIPMENT_COLUMNS)
