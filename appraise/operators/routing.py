"""Route arriving object paths to the make (model type) whose folder they sit in.

A path belongs to a route when it holds ``prefix || make || suffix``. Few routes are
matched by a broadcast nested loop while the paths stream (``FEW_ROUTES``, checked).
Above that the containment becomes an equi-join: a route's text has a shape, the
number of characters before its first slash and in all. A path cuts out, at each of
its slashes, one piece per shape the routes have; a route is contained exactly when
its text is one of these pieces. Texts without a slash are cut out at every
place of the path. Both forms give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions.text import run_name

# Makes, folder markers and run name prefixes of the triggers.
MODEL_TYPES = ("toyota", "daihatsu")
TRAINING_SUFFIX = "/lelang/"
SCORING_PREFIX, SCORING_SUFFIX = "batch-transform/", ""
RESULT_MARKER = "/with_header/"
TRAINING_RUN_PREFIX = "Training"
SCORING_RUN_PREFIX = "BatchTransform"

FEW_ROUTES = 100        # up to here a path is compared with every route
MAX_SHAPES = 10_000     # distinct (before the slash, length) pairs; they travel with the plan


def routes_table(spark: SparkSession, model_types: Sequence[str] = MODEL_TYPES,
                 suffix: str = TRAINING_SUFFIX, run_prefix: str = TRAINING_RUN_PREFIX,
                 prefix: str = "") -> DataFrame:
    """(model_type, prefix, suffix, run_name) rows; the make -> run name lookup as a column."""
    rows = [(m, prefix, suffix) for m in model_types]
    return (spark.createDataFrame(rows, "model_type string, prefix string, suffix string")
            .withColumn("run_name", run_name(run_prefix, F.col("model_type"))))


def scoring_routes(spark: SparkSession, model_types: Sequence[str] = MODEL_TYPES,
                   prefix: str = SCORING_PREFIX) -> DataFrame:
    """Routes of the scoring trigger: files under ``batch-transform/<make>``."""
    return routes_table(spark, model_types, SCORING_SUFFIX, SCORING_RUN_PREFIX, prefix)


def _needle() -> Column:
    return F.concat(F.coalesce("prefix", F.lit("")), "model_type", "suffix")


def _pieces(path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Every distinct text of one of the shapes (characters before the first slash or -1, length) in the path."""
    around = [(before, size) for before, size in shapes if before >= 0]
    loose = sorted({size for before, size in shapes if before < 0})
    n = F.length(path)

    def cut(place: Column, sizes: list[tuple[int, int]]) -> Column:
        """Texts that hold the character at ``place`` after ``before`` others; null where the path is too short."""
        offered = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(m).alias("m")) for b, m in sizes])
        return F.transform(offered, lambda s: F.when(
            (place > s["b"]) & (place - s["b"] + s["m"] <= n + 1), F.substring(path, place - s["b"], s["m"])))
    places = F.sequence(F.lit(1), n)
    out = []
    if around:
        slashes = F.filter(places, lambda i: F.substring(path, i, F.lit(1)) == "/")
        out.append(F.flatten(F.transform(slashes, lambda i: cut(i, around))))
    if loose:
        out.append(F.flatten(F.transform(places, lambda i: cut(i, [(0, m) for m in loose]))))
    return F.when(n > 0, F.filter(F.array_distinct(F.concat(*out)), lambda x: x.isNotNull()))


def route_paths(paths: DataFrame, path_col: str, routes: DataFrame, few: int = FEW_ROUTES) -> DataFrame:
    """Every (path, route) pair where the path holds ``prefix || model_type || suffix``.

    Null paths and routes with a null part match nothing; a route without any text matches every path.
    """
    if routes.limit(few + 1).count() <= few:
        return paths.join(F.broadcast(routes), F.col(path_col).contains(_needle()), "inner").drop("prefix", "suffix")
    known = routes.withColumn("__needle", _needle()).filter(F.col("__needle").isNotNull())
    shapes = [tuple(r) for r in known.filter("__needle <> ''").select(
        (F.instr("__needle", "/") - 1).alias("before"), F.length("__needle").alias("size")).distinct()
        .limit(MAX_SHAPES + 1).collect()]
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"routes have more than {MAX_SHAPES} shapes")
    cut = _pieces(F.col(path_col), sorted(shapes)) if shapes else F.array().cast("array<string>")
    every = F.when(F.col(path_col).isNotNull(), F.concat(F.array(F.lit("")), F.coalesce(cut, F.array().cast("array<string>"))))
    pieces = paths.withColumn("__needle", F.explode(every))
    return pieces.join(known, "__needle").drop("__needle", "prefix", "suffix")
