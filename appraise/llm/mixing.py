"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to). Each pattern offers its words once per repetition, every repetition dearer
than the one before (convex costs); a min-cost flow routes that capacity to the
sources' quotas. Inside a pattern documents are ranked by a seeded hash and the
flow's amounts become cut points in that order.

Only overlaps need the flow: a source whose documents belong to no other source fills
its quota from its one pattern, first uses before second ones, which is the flow's
own answer there and is computed as columns, for any number of sources. Targets are
found by raising one level over the sources' sizes by weight, an aggregate a step.

Cut points need no global order: a histogram of the hash finds the bucket that
each cut falls in, and only documents of such buckets are ranked exactly. The
driver sees one row per overlapping pattern and per source of such a pattern
(``MAX_PATTERNS`` patterns at most, an error beyond), never documents.

Null text has size 0 and is taken zero words; a null id is an id like others, a null
source a source of its own, last in order. Long texts count whole. Rows repeated in
full are ranked one after the other, so a cut may fall between them; equal hashes are
ordered by id and text. Empty tables give empty results; other columns are carried in
a struct, so their names are free.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from appraise.llm.common import WORD, cut, documents, id_of, real_id, text_of

WEIGHTS = (3, 1, 2)         # by source in code point order, repeating
SHARE = 1.5                 # words of the mix over words of the documents
COSTS = (0.0, 1.0)          # cost of a word's first and second use; its length is the repetition limit
SEED = 20
BUCKETS = 1 << 12
MAX_PATTERNS = 100_000      # overlapping patterns the driver may hold; more fail rather than being cut


def _level(sources: DataFrame, share: float, limit: int) -> tuple[float, float]:
    """(words left, weight left) when no open source's share exceeds ``limit`` times its size.

    A source is full once its weight times the level is more than it may give; what
    full sources leave raises the level of the others.
    """
    n, w = F.col("n"), F.col("w")
    total = sources.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    goal = share * (total["n"] or 0)
    left, weight = goal, float(total["w"] or 1)
    while True:
        full = F.lit(left) * w / F.lit(weight) > limit * n
        now = sources.agg(F.sum(F.when(full, n)).alias("n"), F.sum(F.when(~full, w)).alias("w")).first()
        again = (max(0.0, goal - limit * (now["n"] or 0)), float(now["w"] or 0))
        if again[1] == 0 or again == (left, weight):
            return (left, weight) if again[1] else (0.0, 0.0)
        left, weight = again


def with_targets(sizes: DataFrame, share: float = SHARE, limit: int = len(COSTS),
                 weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, n`` with ``target``: by weight, none above ``limit`` times its size, the excess shared anew.

    Weights repeat over the sources in code point order, null last. The order is
    numbered range by range, so any number of sources will do.
    """
    order = F.col("source").asc_nulls_last()
    local = cut(sizes.repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
                .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)     # a row per range
    offsets = local.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = (F.col("_off") + F.col("_at")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    known = cut(local.join(F.broadcast(offsets), "_part").select("source", "n", weight.alias("w")), "weights")
    left, open_weight = _level(known, share, limit)
    most = (limit * F.col("n")).cast("double")
    even = F.lit(left) * F.col("w") / F.lit(open_weight) if open_weight else most
    return known.select("source", "n", F.when(even > most, most).otherwise(even).alias("target"))


def min_cost_flow(capacity: list[float], members: list[list[int]], quota: list[float],
                  costs: tuple[float, ...] = COSTS) -> list[dict[int, float]]:
    """Words routed from each pattern to each of its sources, cheapest way to fill the quotas.

    Successive cheapest augmenting paths (queue-based label correction) on the
    graph start -> pattern (one arc per repetition) -> source -> end.
    """
    n_p, n_q = len(capacity), len(quota)
    start, end = n_p + n_q, n_p + n_q + 1
    head, room, price, out = [], [], [], [[] for _ in range(n_p + n_q + 2)]

    def arc(a, b, r, c):
        for x, y, rr, cc in ((a, b, r, c), (b, a, 0.0, -c)):
            out[x].append(len(head))
            head.append(y)
            room.append(rr)
            price.append(cc)

    for p, size in enumerate(capacity):
        for c in costs:
            arc(start, p, float(size), c)
    for p, qs in enumerate(members):
        for q in qs:
            arc(p, n_p + q, float("inf"), 0.0)
    for q, amount in enumerate(quota):
        arc(n_p + q, end, amount, 0.0)
    least = 1e-9 * max(1.0, sum(quota))
    while True:
        dist, via, queued = [float("inf")] * len(out), [-1] * len(out), [False] * len(out)
        dist[start], queue = 0.0, deque([start])
        while queue:
            a = queue.popleft()
            queued[a] = False
            for e in out[a]:
                if room[e] > least and dist[a] + price[e] < dist[head[e]] - 1e-12:
                    dist[head[e]], via[head[e]] = dist[a] + price[e], e
                    if not queued[head[e]]:
                        queued[head[e]] = True
                        queue.append(head[e])
        if via[end] < 0:
            break
        path, node = [], end
        while node != start:
            path.append(via[node])
            node = head[via[node] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    flow: list[dict[int, float]] = [{} for _ in capacity]
    for p in range(n_p):
        for e in out[p]:
            if n_p <= head[e] < n_p + n_q and room[e ^ 1] > least:
                flow[p][head[e] - n_p] = room[e ^ 1]
    return flow


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def mix(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text",
        share: float = SHARE, costs: tuple[float, ...] = COSTS,
        weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(per document, per source).

    ``sources`` is an array column: the sources a document belongs to. Documents:
    ``_id, _th, _members, size, taken, routes`` (the source each use counts for).
    Sources: ``source, source_size, target``.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    base = docs.select(id_of(id_col).alias("_id"), F.xxhash64(text).alias("_th"), n_words(text).alias("size"),
                       F.array_sort(F.array_distinct(sources)).alias("_members"))
    base = base.withColumn("_h", F.xxhash64(F.lit(seed), "_id", "_th"))
    base = cut(base.withColumn("_b", F.shiftrightunsigned("_h", 64 - BUCKETS.bit_length() + 1).cast("int")), "mix")

    per_source = cut(with_targets(base.select(F.explode("_members").alias("source"), "size").groupBy("source").agg(
        F.sum("size").alias("n")), share, len(costs), weights), "targets")
    overlaps = base.where(F.size("_members") > 1).groupBy("_members").agg(F.sum("size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(overlaps) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} overlapping membership patterns: merge sources first")

    # A source by itself: its target stacked along the repetitions of its one pattern.
    size, at = F.col("n"), F.col("target")
    tier = F.greatest(F.lit(0), F.least(F.lit(len(costs) - 1), F.when(at % size > 0, F.floor(at / size)).otherwise(F.floor(at / size) - 1)))
    members = F.array(F.col("source").cast("string"))
    alone = per_source.where((size > 0) & (at > 0))
    cuts = []
    if overlaps:
        mixed = {s for r in overlaps for s in r["_members"]}
        named = spark.createDataFrame([(s, True) for s in mixed], "_s string, _mixed boolean")
        known = per_source.join(named, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        alone = known.where("_mixed IS NULL").where((size > 0) & (at > 0))
        quotas = sorted(known.where("_mixed").collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
        single = base.where(F.size("_members") == 1).select(F.get("_members", F.lit(0)).alias("_s0"), "size").join(
            named, F.col("_s0").eqNullSafe(F.col("_s"))).groupBy("_s0").agg(F.sum("size").alias("n")).collect()
        patterns = [(list(r["_members"]), r["n"]) for r in overlaps] + [([r["_s0"]], r["n"]) for r in single]
        patterns.sort(key=lambda x: [(s is None, s or "") for s in x[0]])
        names = [r["source"] for r in quotas]
        place = {s: i for i, s in enumerate(names)}
        flow = min_cost_flow([n for _, n in patterns], [[place[s] for s in m] for m, _ in patterns],
                             [r["target"] for r in quotas], costs)
        for (pattern, n), routed in zip(patterns, flow):
            total = 0.0
            for q in sorted(routed):
                total += routed[q]
                step = max(0, min(len(costs) - 1, int(total // n) if total % n else int(total // n) - 1))
                cuts.append((pattern, names[q], step, total - step * n))
    cut_rows = alone.select(members.alias("_members"), F.col("source").alias("route"), tier.cast("int").alias("tier"),
                            (at - tier * size).alias("amount"))
    if cuts:
        cut_rows = cut_rows.unionByName(spark.createDataFrame(cuts, "_members array<string>, route string, tier int, amount double"))
    # Cut: else the sums would be dealt by pattern alone, for the running sums' sake.
    hist = cut(base.groupBy("_members", "_b").agg(F.sum("size").alias("n")), "hist")
    run = Window.partitionBy("_members").orderBy("_b")
    hist = hist.withColumn("upto", F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    hist = hist.withColumn("before", F.col("upto") - F.col("n"))
    # The first bucket that reaches the amount holds the cut; its rest is spent inside.
    found = hist.join(cut_rows, "_members").where("upto >= amount").groupBy("_members", "route", "tier", "amount").agg(
        F.min(F.struct("_b", "before")).alias("x")).select(
        "_members", F.struct("tier", "amount", F.col("x._b").alias("b"),
                             (F.col("amount") - F.col("x.before")).alias("rest"), "route").alias("c"))
    per_pattern = cut(found.groupBy("_members").agg(F.array_sort(F.collect_list("c")).alias("_cuts")), "cuts")

    # One row per pattern. Up to MAX_PATTERNS they are broadcast, and no pattern's documents meet in a task;
    # beyond that the join is Spark's, which splits a pattern that holds much of the table.
    few = per_pattern.limit(MAX_PATTERNS + 1).count() <= MAX_PATTERNS
    placed = base.join(F.broadcast(per_pattern) if few else per_pattern, "_members", "left")
    in_cut = F.exists(F.coalesce("_cuts", F.array().cast("array<struct<tier:int,amount:double,b:int,rest:double,route:string>>")),
                      lambda c: c["b"] == F.col("_b"))
    order = Window.partitionBy("_members", "_b").orderBy("_h", "_id", "_th").rowsBetween(
        Window.unboundedPreceding, 0)
    exact = placed.where(in_cut).withColumn("_mid", F.sum("size").over(order) - F.col("size") / 2)
    ranked = placed.where(~in_cut).withColumn("_mid", F.lit(0.0)).unionByName(exact)

    def below(c):
        return (F.col("_b") < c["b"]) | ((F.col("_b") == c["b"]) & (F.col("_mid") < c["rest"]))

    # For each repetition: the first cut the document lies below names the source it counts for.
    routes = F.filter(F.transform(
        F.sequence(F.lit(0), F.lit(len(costs) - 1)),
        lambda k: F.get(F.filter("_cuts", lambda c: (c["tier"] > k) | ((c["tier"] == k) & below(c))), 0)),
        lambda c: c.isNotNull())
    ranked = ranked.withColumn("routes", F.coalesce(F.transform(routes, lambda c: c["route"]),
                                                    F.array().cast("array<string>")))
    per_doc = ranked.select("_id", "_th", "_members", "size",
                            (F.col("size") * F.size("routes")).cast("long").alias("taken"), "routes")
    return per_doc, per_source.select("source", F.col("n").alias("source_size"), "target")


def mixed_documents(docs: DataFrame, source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns as before.

    Of rows equal in id, text and source, as many are listed as often as ``mix`` says.
    """
    members = F.array(F.col(f"`{source_col}`").cast("string"))
    per_doc, _ = mix(docs, members, **how)
    key = ["_id", "_th", "_members"]
    used = cut(per_doc.select(*key, F.size("routes").alias("_uses")), "uses")
    uses = used.groupBy(*key).agg(F.max("_uses").alias("_uses"), F.min("_uses").alias("_least"))
    names, text = docs.columns, text_of(how.get("text_col", "text"))
    whole = docs.select(F.struct("*").alias("_doc"), id_of(how.get("id_col", "doc_id")).alias("_id"),
                        F.xxhash64(text).alias("_th"), members.alias("_members"))

    def listed(rows: DataFrame) -> DataFrame:
        return rows.where("_uses > 0").select("_doc", F.explode(F.sequence(F.lit(1), "_uses"))).select(
            *[F.col("_doc").getField(n).alias(n) for n in names])

    def keyed_join(rows: DataFrame, other: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        other = other.withColumnRenamed("_members", "_m")
        return rows.join(other, ["_id", "_th", *extra]).where(F.col("_members").eqNullSafe(F.col("_m"))).drop("_m")
    split = cut(uses.where("_least < _uses").select(*key), "split")
    even = uses.where("_least = _uses").drop("_least")
    out = listed(keyed_join(whole, even))
    if split.head(1):               # a cut between equal rows: each its own number
        order = Window.partitionBy(*key)
        mine = keyed_join(used, split).withColumn("_nth", F.row_number().over(order.orderBy(F.desc("_uses"))))
        rows = keyed_join(whole, split).withColumn("_nth", F.row_number().over(order.orderBy(F.xxhash64("_doc"))))
        out = out.unionByName(listed(keyed_join(rows, mine, ("_nth",))))
    return out


def op6_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document."""
    docs = documents(spark, sf_dir)
    per_doc, totals = mix(docs, F.array(F.col("source").cast("string")))
    return per_doc.withColumn("source", F.get("_members", F.lit(0))).join(
        totals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        real_id("_id").alias("doc_id"), "size", "source_size", "target", "taken")
