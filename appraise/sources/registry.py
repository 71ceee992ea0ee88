"""Model and tuning registries as plain Parquet tables.

models: name, model_type, created_at, path, params MAP<STRING,STRING>, rmse
trials: job (one id per search), trial_id, model_type, status, created_at, rmse, params MAP<STRING,STRING>

Registering appends one row; "newest model" and "best parameters" are reads
with a filter and a per-key ``min_by`` (see ``operators.latest``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions.text import capitalize

MODELS_SCHEMA = ("name string, model_type string, created_at timestamp, path string, "
                 "params map<string,string>, rmse double")
TRIALS_SCHEMA = ("job string, trial_id bigint, model_type string, status string, "
                 "created_at timestamp, rmse double, params map<string,string>")

# Hyperparameter names carried from tuning to training.
PARAM_NAMES = ("max_depth", "subsample", "colsample_bytree", "num_round", "eta",
               "min_child_weight", "gamma")
PARAM_TYPES = {"max_depth": "int", "subsample": "double", "colsample_bytree": "double",
               "num_round": "int", "eta": "double", "min_child_weight": "int", "gamma": "int"}


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODELS_SCHEMA).parquet(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIALS_SCHEMA).parquet(path)


def register_model(spark: SparkSession, path: str, name: str, model_type: str,
                   model_path: str, params: dict, rmse: float | None,
                   created_at: dt.datetime | None = None) -> None:
    """Append one registry row (one tiny file per registration)."""
    row = (name, model_type, created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           model_path, {k: str(v) for k, v in params.items()}, rmse)
    spark.createDataFrame([row], MODELS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def record_trials(trials: DataFrame, path: str) -> None:
    trials.select(*[c.split()[0] for c in TRIALS_SCHEMA.split(", ")]) \
        .write.mode("append").parquet(path)


def typed_params(params_col: str = "params") -> list:
    """The map of parameter texts as typed columns, one per known parameter."""
    return [F.col(params_col).getItem(k).cast(t).alias(k) for k, t in PARAM_TYPES.items()]


def models_from_events(events: DataFrame) -> DataFrame:
    """Registry stand-in: one model per event, named ``<Make>-model-<id>``."""
    return events.select(
        F.concat(capitalize("event_type"), F.lit("-model-"), F.col("event_id").cast("string"))
        .alias("name"),
        F.col("event_type").alias("model_type"), F.col("ts").alias("created_at"),
        F.concat(F.lit("models/"), F.col("event_type"), F.lit("/"),
                 F.col("event_id").cast("string")).alias("path"))


def trials_from_events(events: DataFrame) -> DataFrame:
    """Trial stand-in: one trial per event, a search per 100 ids; ``value`` is its validation RMSE."""
    return events.select(
        F.concat(F.lit("HPO-"), capitalize("event_type"), F.lit("-"),
                 F.floor(F.col("event_id") / 100).cast("string")).alias("job"),
        F.col("event_id").alias("trial_id"), F.col("event_type").alias("model_type"),
        F.when(F.col("event_type") == "error", F.lit("Failed")).otherwise(F.lit("Completed"))
        .alias("status"),
        F.col("ts").alias("created_at"), F.col("value").alias("rmse"),
        F.from_json("props", "map<string,string>").alias("params"))
