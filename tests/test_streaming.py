import json
import os

from appraise.operators.routing import routes_table
from appraise.session import scratch_path
from appraise.sources.workbook import local_path
from appraise.streaming.events import (notification_rows, read_notifications, records,
                                       run_requests, stream_notifications)
from appraise.streaming.sinks import run_available

KEYS = ["in/training/toyota/lelang/20240101/a.csv", "in/training/daihatsu/other/a.csv",
        "out/batch-transform/toyota/with_header/20240101/prediction_results.csv"]


def _land(folder, name, keys):
    os.makedirs(folder, exist_ok=True)
    recs = [{"eventTime": "2024-01-01T00:00:00.000Z", "eventName": "ObjectCreated:Put",
             "s3": {"bucket": {"name": "bkt"}, "object": {"key": k}}} for k in keys]
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(json.dumps({"Records": recs}) + "\n")


def test_stream_equals_batch_and_restart_is_empty(spark):
    incoming = scratch_path(spark, "in")
    _land(local_path(incoming), "n1.json", KEYS[:2])
    _land(local_path(incoming), "n2.json", KEYS[2:])
    routes = routes_table(spark)
    batch = run_requests(records(read_notifications(spark, incoming)), routes)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    out = run_requests(records(stream_notifications(spark, incoming, 1)), routes)
    assert run_available(out, sink, ckpt) >= 1
    got = spark.read.parquet(sink).drop("batch_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert [r["model_type"] for r in got.collect()] == ["toyota"]
    # a second run on the same checkpoint finds nothing new
    assert run_available(out, sink, ckpt) == 0
    # a new file is picked up by the next run
    _land(local_path(incoming), "n3.json", KEYS[:1])
    assert run_available(out, sink, ckpt) == 1
    assert spark.read.parquet(sink).count() == 2


def test_notification_rows(spark):
    incoming = scratch_path(spark, "in")
    _land(local_path(incoming), "n.json", KEYS)
    rows = notification_rows(records(read_notifications(spark, incoming)), ["a@example.com"]) \
        .collect()
    assert len(rows) == 1
    assert rows[0]["file_name"] == "prediction_results.csv"
    assert rows[0]["attachment_path"] == "s3://bkt/" + KEYS[2]
    assert "ObjectCreated:Put" in rows[0]["html_body"]


def test_run_inputs_attached_per_make(spark):
    import datetime as dt

    from appraise.operators.latest import best_per_key, latest_per_key
    from appraise.streaming.events import attach_run_inputs
    incoming = scratch_path(spark, "in")
    _land(local_path(incoming), "n.json", KEYS)
    trials = spark.createDataFrame(
        [("toyota", 1, "Completed", 3.0, {"max_depth": "4"}),
         ("toyota", 2, "Completed", 2.0, {"max_depth": "6"}),
         ("toyota", 3, "Failed", 1.0, {"max_depth": "9"})],
        "model_type string, trial_id long, status string, rmse double, "
        "params map<string,string>")
    best = best_per_key(trials.filter("status = 'Completed'"), ["model_type"], "rmse",
                        "trial_id", ["params"])
    models = spark.createDataFrame(
        [("toyota", "Toyota-a", "p/a", dt.datetime(2024, 1, 1)),
         ("toyota", "Toyota-b", "p/b", dt.datetime(2024, 2, 1)),
         ("daihatsu", "Daihatsu-a", "p/c", dt.datetime(2024, 3, 1))],
        "model_type string, model_name string, model_path string, created_at timestamp")
    newest = latest_per_key(models, ["model_type"], "created_at", "model_name",
                            ["model_name", "model_path"])
    req = run_requests(records(stream_notifications(spark, incoming, 1)), routes_table(spark))
    out = attach_run_inputs(req, best, newest)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run_available(out, sink, ckpt)
    rows = spark.read.parquet(sink).collect()
    assert len(rows) == 1
    assert rows[0]["params"]["max_depth"] == "6" and rows[0]["model_name"] == "Toyota-b"


def test_joined_paths_in_record_order(spark):
    from appraise.streaming.events import joined_paths
    incoming = scratch_path(spark, "in")
    _land(local_path(incoming), "n.json", KEYS)
    row = joined_paths(read_notifications(spark, incoming)).first()
    assert row["paths"] == ",".join(f"s3://bkt/{k}" for k in KEYS)


def test_pretty_printed_notification(spark):
    incoming = scratch_path(spark, "in")
    folder = local_path(incoming)
    os.makedirs(folder, exist_ok=True)
    recs = [{"eventTime": "t", "eventName": "ObjectCreated:Put",
             "s3": {"bucket": {"name": "bkt"}, "object": {"key": k}}} for k in KEYS]
    with open(os.path.join(folder, "event.json"), "w") as fh:
        json.dump({"Records": recs}, fh, indent=2)
    got = records(read_notifications(spark, incoming, multiline=True)).collect()
    assert [r["key"] for r in got] == KEYS
