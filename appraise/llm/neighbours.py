"""Approximate nearest neighbours by a low-dimensional projected index.

Method: vectors are projected to ``DIMENSIONS`` numbers by fixed Gaussian (2-stable)
directions, so the squared projected distance over the squared distance of two
vectors follows a chi-square law with as many degrees of freedom. A kd-tree holds the
projections; a query takes its projected neighbours in rising order, verifies each by
the original vectors, and stops when the chi-square test holds: were a vector as near
as the worst of the best found, it would have come up by now with probability
``CONFIDENCE``. No number of candidates is set; the test alone ends a search.

Spark: equal vectors are one class, which keeps its smallest ids (window limits
before the shuffle), so a third of all rows being copies of one vector costs one entry. The
upper levels of the kd-tree are fitted on a sample of about ``SAMPLE`` projections;
they cut the classes into at most ``CELLS`` cells, and a cell into blocks of about ``BLOCK``
classes by hash. Every class is indexed. Round one searches each query's own block
and bounds its distances; round two visits the blocks of the cells whose box the stopping
radius reaches, starting from that bound. A task holds one block and streams
the queries that visit it; a block that many queries visit is dealt out several times.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do those of another length than the most common one (the
shorter of two equally common). Ties go to the smaller id, null ids last. Repeated
rows are candidates of each other, and every query row has a list of its own; rows
with a null id are no queries. Fewer candidates than asked for are all returned. An
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from appraise.llm.common import batch_of, cut, one_thread, shuffle_width

NEIGHBOURS = 10
DIMENSIONS = 8              # even: the chi-square quantile below has a closed form then
CONFIDENCE = 0.9
SAMPLE = 1 << 14
CELLS = 1 << 10
BLOCK = 1 << 13
LEAF = 128
VISITORS = 1 << 12          # queries that one copy of a block serves
SEED = 11


def directions(length: int, dims: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((length, dims))


def chi_square_quantile(p: float, dims: int) -> float:
    """The value that a chi-square variable of an even number of degrees stays below with probability p."""
    def below(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))
    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Tree:
    """kd-tree over projections ``y``; ``x`` are the original vectors, both in leaf order."""

    def __init__(self, x: np.ndarray, y: np.ndarray, leaf: int = LEAF):
        order, self.nodes = np.arange(len(y)), []
        self._build(y, order, 0, len(y), leaf)
        self.order, self.x, self.y = order, x[order], y[order]

    def _build(self, y, order, start, end, leaf):
        at = len(self.nodes)
        self.nodes.append(None)
        part = y[order[start:end]]
        spread = part.max(0) - part.min(0)
        dim = int(spread.argmax())
        if end - start <= leaf or spread[dim] == 0:
            self.nodes[at] = (start, end)
            return at
        middle = (end - start) // 2
        by = np.argpartition(part[:, dim], middle)
        order[start:end] = order[start:end][by]
        split = float(y[order[start + middle], dim])
        left = self._build(y, order, start, start + middle, leaf)
        right = self._build(y, order, start + middle, end, leaf)
        self.nodes[at] = (dim, split, left, right)
        return at

    def rising(self, point: np.ndarray, limit):
        """Places by rising projected distance, in runs; ends at the squared radius ``limit()``."""
        q = point.tolist()
        heap, tie = [(0.0, 0, 0, (0.0,) * len(q))], 0
        while heap:
            near, _, node, rest = heapq.heappop(heap)
            if near > limit():
                return
            if node is None:                        # a run of one leaf: (distances, places)
                far, places = rest
                stop = limit()
                until = max(np.searchsorted(far, heap[0][0] if heap else math.inf, "right"), min(len(far), LEAF // 2))
                inside = min(until, np.searchsorted(far, stop, "right"))
                yield places[:inside]
                if inside == until < len(far):
                    tie += 1
                    heapq.heappush(heap, (float(far[until]), tie, None, (far[until:], places[until:])))
                continue
            while len(self.nodes[node]) == 4:       # down to the leaf, the other sides wait
                dim, split, left, right = self.nodes[node]
                gap = q[dim] - split
                node, other = (left, right) if gap < 0 else (right, left)
                beyond = near - rest[dim] + max(gap * gap, rest[dim])
                tie += 1
                heapq.heappush(heap, (beyond, tie, other, rest[:dim] + (max(gap * gap, rest[dim]),) + rest[dim + 1:]))
            start, end = self.nodes[node]
            offset = self.y[start:end] - point
            far = (offset * offset).sum(1)
            by = far.argsort(kind="stable")
            tie += 1
            heapq.heappush(heap, (float(far[by[0]]), tie, None, (far[by], start + by)))


def search(tree: Tree, sizes: np.ndarray, vector, point, bound: float, wanted: int, quantile: float):
    """Distances and places of the classes that hold the nearest ``wanted`` rows not beyond ``bound``."""
    best, places, worst = np.zeros(0), np.zeros(0, np.int64), bound
    for run in tree.rising(point, lambda: worst * worst * quantile):
        if not len(run):
            continue
        offset = tree.x[run] - vector
        far = np.sqrt((offset * offset).sum(1))
        inside = far <= worst
        best, places = np.concatenate([best, far[inside]]), np.concatenate([places, run[inside]])
        if len(best) > wanted or sizes[places].sum() >= wanted:
            by = best.argsort(kind="stable")
            best, places = best[by], places[by]
            full = np.searchsorted(np.cumsum(sizes[places]), wanted)
            if full < len(best):
                worst = min(worst, float(best[full]))
                keep = np.searchsorted(best, worst, "right")
                best, places = best[:keep], places[:keep]
    return best, places


def _rows(column, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


FOUND = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("vec", pa.int64()), ("own", pa.bool_())])
FOUND_DDL = "query long, score double, vec long, own boolean"


def _visits(wanted: int, quantile: float, leaf: int):
    """Rows come by unit: a block's classes, then the queries that visit it."""
    def run(batches):
        unit, held, tree = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "salt", "rep", "kind")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            out = []
            for s, e in zip(edges, edges[1:]):
                if tuple(keys[s, :3]) != unit:
                    unit, held, tree = tuple(keys[s, :3]), [], None
                part = batch.slice(s, e - s)
                if keys[s, 3] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if tree is None:
                    block = pa.Table.from_batches(held)
                    tree = Tree(_rows(block["vec"]), _rows(block["y"]), leaf)
                    classes, ids = block["class"].to_numpy(), block["ids"].to_pylist()
                    sizes = np.array([len(i) for i in ids])[tree.order]
                for query, vector, point, bound in zip(part.column("class").to_numpy().tolist(), _rows(part.column("vec")),
                                                       _rows(part.column("y")), part.column("bound").to_numpy()):
                    best, places = search(tree, sizes, vector, point, bound, wanted, quantile)
                    found = [(score, vec is None, vec or 0, classes[at] == query)
                             for score, at in zip(best.tolist(), tree.order[places].tolist()) for vec in ids[at]]
                    found.sort()
                    out.extend((query, score, None if null else vec, bool(own)) for score, null, vec, own in found[:wanted])
            if out:
                yield batch_of(FOUND, list(zip(*out)))
    return run


def top_levels(sample: np.ndarray, cells: int) -> tuple[list[int], list[float]]:
    """Splitting dimension and value of each inner node, numbered 1, 2, 3 (2 and 3 below 1), ..."""
    dims, values = [0] * cells, [0.0] * cells

    def split(node, part):
        if node >= cells:
            return
        if len(part):
            dims[node] = int((part.max(0) - part.min(0)).argmax())
            values[node] = float(np.median(part[:, dims[node]]))
        side = part[:, dims[node]] < values[node] if len(part) else np.zeros(0, bool)
        split(2 * node, part[side])
        split(2 * node + 1, part[~side])

    split(1, sample)
    return dims, values


def usable(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, vec`` of the rows that take part."""
    kind = embeddings.schema[vec_col].dataType.simpleString()
    vec = F.col(f"`{vec_col}`")
    d = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                          (vec if kind == "array<float>" else vec.cast("array<double>")).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    d = d.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(finite).where(F.exists("vec", lambda x: x != 0))
    common = d.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return d.where(F.size("vec") == (common.n if common else 0))


def _pick(values: list, at: Column) -> Column:
    return F.element_at(F.lit(values), (at + 1).cast("int"))


def nearest(embeddings: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id", vec_col: str = "embedding",
            confidence: float = CONFIDENCE, block: int = BLOCK, leaf: int = LEAF, visitors: int = VISITORS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose ``is_query`` (over ``id``) holds, its k nearest rows."""
    spark, wanted = embeddings.sparkSession, k + 1          # one may be the query itself
    rows = usable(embeddings, id_col, vec_col).select(
        "id", "vec", F.xxhash64("vec").alias("h"), F.coalesce(is_query, F.lit(False)).alias("isq"))
    place = F.row_number().over(Window.partitionBy("h", "vec", "isq").orderBy(F.col("id").asc_nulls_last()))
    by_id = F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id")))
    classes = rows.withColumn("place", place).where(F.col("place") <= wanted).groupBy("h", "vec").agg(
        F.transform(F.slice(by_id, 1, wanted), lambda e: e["id"]).alias("ids"), F.max("isq").alias("isq"))
    kind = rows.schema["vec"].dataType.simpleString()

    def project(batches):
        schema = pa.schema([("h", pa.int64()), ("vec", pa.list_(pa.float32() if kind == "array<float>" else pa.float64())),
                            ("ids", pa.list_(pa.int64())), ("isq", pa.bool_()), ("y", pa.list_(pa.float64()))])
        one_thread()
        table = None
        for b in batches:
            if len(b):
                x = _rows(b.column("vec"))
                table = directions(x.shape[1]) if table is None else table
                yield batch_of(schema, [*(b.column(c) for c in ("h", "vec", "ids", "isq")), list(x @ table)])

    classes = cut(classes.mapInArrow(project, f"h long, vec {kind}, ids array<long>, isq boolean, y array<double>")
                  .withColumn("class", F.monotonically_increasing_id()), "classes")

    n = classes.count()
    share = min(1.0, SAMPLE / max(n, 1))
    sample = classes.where(F.pmod(F.xxhash64("h", "class"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("y").collect()
    depth = min(CELLS, max(1, math.ceil(n / block)) - 1).bit_length()
    cells = 1 << min(depth, CELLS.bit_length() - 1)
    dims, values = top_levels(np.array([r.y for r in sample]).reshape(len(sample), DIMENSIONS), cells)
    node = F.lit(1)
    if cells > 1:
        node = F.aggregate(F.sequence(F.lit(1), F.lit(cells.bit_length() - 1)), F.lit(1), lambda at, _: F.when(
            F.element_at("y", _pick(dims, at) + 1) < _pick(values, at), 2 * at).otherwise(2 * at + 1))
    placed = classes.withColumn("cell", (node - cells).cast("int"))
    edge = [f(F.element_at("y", j + 1)).alias(f"{name}{j}") for f, name in ((F.min, "lo"), (F.max, "hi")) for j in range(DIMENSIONS)]
    known = {r.cell: r for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum(F.col("isq").cast("long")).alias("q"), *edge).collect()}     # a row per cell
    salts = [max(1, math.ceil(known[c].n / block)) if c in known else 1 for c in range(cells)]
    low, high = (np.array([[known[c][f"{name}{j}"] if c in known else math.inf for j in range(DIMENSIONS)]
                           for c in range(cells)]) for name in ("lo", "hi"))
    quantile = chi_square_quantile(confidence, DIMENSIONS)
    points = placed.withColumn("salt", F.pmod(F.xxhash64("class"), _pick(salts, F.col("cell"))).cast("int"))
    queries = points.where("isq").withColumn("home", F.col("salt"))

    def met(visits: DataFrame, counts: list[int]) -> DataFrame:
        reps = [math.ceil(c / visitors) for c in counts]
        names = ("cell", "salt", "rep", "kind", "class", "vec", "y", "ids", "bound")
        served = points.where(_pick(reps, F.col("cell")) > 0).select("*", F.explode(F.sequence(
            F.lit(0), _pick(reps, F.col("cell")) - 1)).alias("rep"), F.lit(0).alias("kind"), F.lit(math.inf).alias("bound"))
        asked = visits.select("*", F.pmod(F.xxhash64("class", "salt"), _pick(reps, F.col("cell"))).cast("int").alias("rep"),
                              F.lit(1).alias("kind"))
        units = sum(s * r for s, r in zip(salts, reps))
        return served.select(*names).unionByName(asked.withColumn("ids", F.lit(None).cast("array<long>")).select(*names)) \
            .repartition(max(shuffle_width(spark), min(units, 1 << 15)), "cell", "salt", "rep") \
            .sortWithinPartitions("cell", "salt", "rep", "kind").mapInArrow(_visits(wanted, quantile, leaf), FOUND_DDL)

    first = cut(met(queries.withColumn("bound", F.lit(math.inf)),
                    [math.ceil(known[c].q / salts[c]) if c in known else 0 for c in range(cells)]), "near")
    bounds = first.groupBy("query").agg(F.when(F.count("*") >= wanted, F.max("score")).otherwise(math.inf).alias("bound"))

    def reached(batches):
        """Cells whose box lies within the stopping radius of each query."""
        schema = pa.schema([("class", pa.int64()), ("bound", pa.float64()), ("cells", pa.list_(pa.int32()))])
        for b in batches:
            if len(b):
                y, bound = _rows(b.column("y")), b.column("bound").to_numpy()
                out = []
                for point, limit in zip(y, bound * bound * quantile):
                    gap = np.maximum(np.maximum(low - point, point - high), 0)
                    out.append(np.flatnonzero((gap * gap).sum(1) <= limit).astype(np.int32))
                yield batch_of(schema, [b.column("class"), b.column("bound"), out])

    asked = queries.select("class", "y").join(bounds.withColumnRenamed("query", "class"), "class")
    reach = cut(asked.mapInArrow(reached, "class long, bound double, cells array<int>")
                .select("class", "bound", F.explode("cells").alias("cell")), "reach")
    counts = {r.cell: r["count"] for r in reach.groupBy("cell").count().collect()}
    visits = queries.select("class", "vec", "y", F.col("cell").alias("own"), "home").join(reach, "class")
    visits = visits.withColumn("salt", F.explode(F.sequence(F.lit(0), _pick(salts, F.col("cell")) - 1))) \
        .where((F.col("cell") != F.col("own")) | (F.col("salt") != F.col("home")))
    second = met(visits, [counts.get(c, 0) if c in known else 0 for c in range(cells)])

    order = Window.partitionBy("query").orderBy("score", F.col("vec").asc_nulls_last())
    lists = first.unionByName(second).withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted) \
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec", "own"))).alias("es"))
    asking = rows.where("isq").select("id", "h", "vec").join(classes.where("isq").select("h", "vec", "class"), ["h", "vec"])
    mine = F.expr("array_position(transform(es, e -> coalesce(e.own AND e.vec = id, false)), true)")
    kept = F.when(mine > 0, F.concat(F.slice("es", F.lit(1), mine - 1), F.slice("es", mine + 1, F.lit(k)))) \
        .otherwise(F.slice("es", 1, k))
    return asking.select("id", "class").join(lists.withColumnRenamed("query", "class"), "class").select(
        F.col("id").alias("query_id"), F.posexplode(kept).alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("e.vec").alias("vec_id"), F.col("e.score").alias("score"))


def op11_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every row whose id is divisible by 100, among all rows."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)
