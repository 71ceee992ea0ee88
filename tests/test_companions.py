"""Companions as of the event, repeated notifications, restarts and bounded state."""
import json

from pyspark.sql import functions as F

from appraise.session import scratch_path
from appraise.streaming.companions import Companions, attach_companion_as_of, deliver_once
from appraise.streaming.events import records, stream_notifications
from appraise.streaming.sinks import run_available


def land(spark, path, rows):
    """rows: (key, minute) as one notification file."""
    recs = [{"eventTime": f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z", "eventName": "put",
             "s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k, m in rows]
    spark.createDataFrame([(json.dumps({"Records": recs}),)], "value string").coalesce(1).write.mode("append").text(path)


def requests(spark, path, sink, ckpt):
    def arrivals():
        return records(stream_notifications(spark, path)).withColumn("event_ts", F.to_timestamp("event_time"))
    crawl = arrivals().filter(F.col("key").contains("/crawling/")).select(
        F.substring_index("key", "/crawling/", 1).alias("prefix"), F.col("key").alias("path"), "event_ts")
    asked = arrivals().filter(F.col("key").contains("/lelang/")).select(
        F.substring_index("key", "/lelang/", 1).alias("prefix"), "event_ts", "key")
    run_available(attach_companion_as_of(asked, crawl), sink, ckpt)
    return {r["key"]: r["companion_path"] for r in spark.read.parquet(sink).collect()}


def test_later_companion_is_not_attached_and_restart_remembers(spark):
    path, sink, ckpt = (scratch_path(spark, x) for x in ("in", "sink", "ckpt"))
    land(spark, path, [("m/crawling/1.csv", 10), ("m/lelang/a.csv", 20), ("m/crawling/2.csv", 30), ("m/lelang/b.csv", 5),
                       ("o/lelang/c.csv", 40), ("m/crawling/0.csv", 30)])
    assert requests(spark, path, sink, ckpt) == {"m/lelang/a.csv": "m/crawling/1.csv", "m/lelang/b.csv": None,
                                                 "o/lelang/c.csv": None}
    land(spark, path, [("m/lelang/d.csv", 50), ("m/lelang/e.csv", 25), ("m/crawling/3.csv", 60)])
    got = requests(spark, path, sink, ckpt)       # a new run on the same checkpoint
    assert got["m/lelang/d.csv"] == "m/crawling/0.csv" and got["m/lelang/e.csv"] == "m/crawling/1.csv" and len(got) == 5


def test_companions_forget():
    c = Companions()
    for t in (5, 1, 9, 5):
        c.land(t, f"p{t}")
    assert [c.as_of(t) for t in (0, 1, 6, 9)] == [None, "p1", "p5", "p9"]
    c.forget_before(6)
    assert c.times == [5, 9] and c.as_of(6) == "p5"


def test_repeated_records_once_and_state_is_bounded(spark):
    path, sink, ckpt = (scratch_path(spark, x) for x in ("in", "sink", "ckpt"))
    for _ in range(3):
        land(spark, path, [("k1", 1), ("k2", 2)])
    stream = deliver_once(records(stream_notifications(spark, path, max_files=1)))
    run_available(stream, sink, ckpt)
    for m in range(100, 1500, 100):               # far later: the first keys leave the store
        land(spark, path, [(f"n{m}", m)])
    land(spark, path, [("k1", 1)])                # too late: behind the watermark
    sizes = []
    query = (stream.writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{sink}/batch_id={i}"))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    sizes = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    got = [r["key"] for r in spark.read.parquet(sink).collect()]
    assert sorted(got) == sorted(["k1", "k2"] + [f"n{m}" for m in range(100, 1500, 100)])
    assert sizes and max(sizes) <= 4
