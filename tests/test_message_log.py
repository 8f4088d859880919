"""SRC6, SNK5, STR2, STR4: a topic folder with keys, partitions and offsets."""

import shutil

import pytest
from pyspark.sql import functions as F

from cargolens.session import delete_path, local_os_path, scratch_path
from cargolens.streaming import message_log as ML


def messages(spark, rows):
    """rows: (key, number); the number is value and sequence."""
    df = spark.createDataFrame(rows, "k string, n long")
    return df.select(F.col("k").cast("binary").alias("key"), F.col("n").cast("string").cast("binary").alias("value"), "n")


def numbers(df):
    return df.select("partition", "offset", F.col("key").cast("string").alias("k"), F.col("value").cast("string").cast("long").alias("n"))


def test_offsets_run_through_and_keys_stay_in_order(spark):
    base = scratch_path(spark, "topic")
    rows = [(f"key{i % 7}" if i % 11 else None, i) for i in range(400)]
    for part in (rows[:250], rows[250:]):
        ML.publish_batch(messages(spark, part).repartition(5), f"{base}/t", 3, "n")
    got = numbers(ML.topic_table(spark, f"{base}/t")).collect()
    assert sorted(r["n"] for r in got) == list(range(400))
    for p in {r["partition"] for r in got}:
        mine = sorted((r["offset"], r["n"]) for r in got if r["partition"] == p)
        assert [o for o, _ in mine] == list(range(len(mine)))
    for k in {r["k"] for r in got if r["k"]}:
        of_key = sorted((r["offset"], r["n"], r["partition"]) for r in got if r["k"] == k)
        assert len({p for *_, p in of_key}) == 1
        assert [n for _, n, _ in of_key] == sorted(n for _, n, _ in of_key)


def test_resume_in_mid_segment_loses_and_repeats_nothing(spark):
    base = scratch_path(spark, "resume")
    ML.publish_batch(messages(spark, [(f"k{i % 5}", i) for i in range(300)]), f"{base}/t", 2, "n")
    source = lambda: ML.topic_stream(spark, f"{base}/t", 40, f"{base}/ckpt")
    # a query that is stopped after its first batches, in the middle of a segment
    query = source().writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt").trigger(processingTime="0 seconds").start()
    while not query.recentProgress:
        query.awaitTermination(0.05)
    query.stop()
    first = spark.read.parquet(f"{base}/out").count()
    assert 0 < first
    ML.publish_batch(messages(spark, [(f"k{i % 5}", i) for i in range(300, 340)]), f"{base}/t", 2, "n")
    ML.drain(source(), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r["n"] for r in numbers(out).collect()) == list(range(340))
    assert out.groupBy("partition", "offset").count().where("count > 1").isEmpty()
    # a further run finds nothing new
    ML.drain(source(), f"{base}/out", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/out").count() == 340


def test_batches_are_bounded_and_a_new_partition_is_seen(spark):
    base = scratch_path(spark, "bounded")
    ML.publish_batch(messages(spark, [("a", i) for i in range(100)]), f"{base}/t", 1, "n")
    query = ML.drain(ML.topic_stream(spark, f"{base}/t", 30, f"{base}/ckpt"), f"{base}/out", f"{base}/ckpt")
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [30, 30, 30, 10]
    ML.publish_batch(messages(spark, [(f"b{i}", 100 + i) for i in range(50)]), f"{base}/t", 4, "n")
    ML.drain(ML.topic_stream(spark, f"{base}/t"), f"{base}/out", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/out").count() == 150


@pytest.mark.parametrize("lost", ["commit", "offset"])
def test_a_replayed_epoch_is_published_once(spark, lost):
    """The checkpoint forgets that the last epoch was committed: it runs again."""
    base = scratch_path(spark, f"epoch_{lost}")
    rows = [(f"k{i % 6}", i) for i in range(200)]
    for at, part in ((0, rows[:120]), (1, rows[120:])):
        spark.createDataFrame(part, "k string, n long").coalesce(1).write.json(f"{base}/in/{at}")

    def publish():
        df = spark.readStream.schema("k string, n long").option("maxFilesPerTrigger", 1).json(f"{base}/in/*")
        df = df.select(F.col("k").cast("binary").alias("key"), F.col("n").cast("string").cast("binary").alias("value"), "n")
        ML.publish_stream(df, f"{base}/t", f"{base}/ckpt", "events", 3, "n")

    publish()
    local = local_os_path(base)
    delete_path(spark, f"{base}/ckpt/commits/1")
    if lost == "offset":  # the mark is lost too, after the places were written down: the commit is finished
        log = ML.Log(f"{base}/t")
        parts = {p: log.segments(p)[-1] for p in log.partitions()}
        shutil.move(f"{local}/t/_epochs/events-{1:012d}", f"{local}/lost-mark")
        import json

        with open(f"{local}/t/_epochs/_plan-events-{1:012d}", "w") as f:
            f.write(json.dumps({str(p): s[0] for p, s in parts.items()}))
    publish()
    got = numbers(ML.topic_table(spark, f"{base}/t")).collect()
    assert sorted(r["n"] for r in got) == list(range(200))
    for k in {r["k"] for r in got}:
        of_key = sorted((r["offset"], r["n"]) for r in got if r["k"] == k)
        assert [n for _, n in of_key] == sorted(n for _, n in of_key)


def test_an_empty_topic(spark):
    base = scratch_path(spark, "empty_topic")
    assert ML.topic_table(spark, f"{base}/none").count() == 0
    ML.publish_batch(messages(spark, []), f"{base}/t", 2, "n")
    assert ML.topic_table(spark, f"{base}/t").count() == 0
