"""SimHash near-duplicates: exact pairs by tiled comparison.

Fingerprints are grouped into tiles by the population counts of their three
parts (22, 21 and 21 bits). Two fingerprints within the radius have part counts
that differ by at most the radius in sum, so tile pairs farther apart are never
compared. A fingerprint is sent to its own tile and to the nearby tiles that
come before it; large tiles are split, so a task holds one bounded piece and
streams the rest past it: numpy exclusive-or and bit counts over the block.

Of the matches of a block only a spanning forest leaves the task (a star for
each local group and one edge for each fingerprint streamed past), so a group
of thousands of near copies costs a linear number of edges; connected
components then give the groups.

Null and empty texts have fingerprint zero and are linked like any other. Null ids
are returned as null and count as the smallest id of their group. Long texts are
hashed whole. Of a group the row of smallest id stays, of equal ids the one of
smallest text hash. Repeated rows share a fingerprint. Empty tables give empty results; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from appraise.llm.common import (batch_of, binary_rows, cut, documents, id_of, real_id, text_of)
from appraise.llm.components import components

SHINGLE = 3
RADIUS = 2
HASH_SEED = 42
TILE = 4096                 # fingerprints of a tile piece held by a task
BLOCK = 512                 # fingerprints streamed past at a time
PARTS = ((0, 22), (22, 21), (43, 21))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = HASH_SEED) -> tuple[np.ndarray, int]:
    """Hashes (uint64) of the word shingles of one text, and their number."""
    import xxhash
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:][:k]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[:k].tolist(), last.tolist())),
                       np.uint64, k), k


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE, seed: int = HASH_SEED) -> np.ndarray:
    """uint64 fingerprint per text: a bit is set if over half the hashes have it."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, t in enumerate(texts):
        h, n = fingerprint(t, shingle, seed)
        if n:
            bits = np.zeros(64, np.int64)
            for at in range(0, n, 1 << 15):      # long texts by pieces
                part = np.ascontiguousarray(h[at:at + (1 << 15)]).view(np.uint8).reshape(-1, 8)
                bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = weights[bits * 2 > n].sum(dtype=np.uint64)
    return out


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = SHINGLE, seed: int = HASH_SEED) -> DataFrame:
    """(_id, _th, fp): the fingerprint as a signed long."""
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fp = fingerprints_of(list(binary_rows(b.column("_text"))), shingle, seed)
            yield batch_of(schema, [b.column("_id"), b.column("_th"), fp.view(np.int64)])

    text = text_of(text_col)
    rows = docs.select(id_of(id_col).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    return rows.mapInArrow(run, "_id long, _th long, fp long")


def _part_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1).cast("long"))).cast("int")
            for at, n in PARTS]


def _tile(counts: list[Column]) -> Column:
    key = F.lit(0)
    for c in counts:
        key = key * 32 + c
    return key


def _forest(batches, radius: int):
    """Rows sorted by (tile, piece, role, fp): held fingerprints first, then those streamed past."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    group, held, label = None, [], None
    edges_a, edges_b = [], []

    def close():
        if label is not None:
            far = np.flatnonzero(label != np.arange(len(label)))
            edges_a.append(held[far])
            edges_b.append(held[label[far]])

    def compare(values):
        nonlocal label
        for at in range(0, len(values), BLOCK):
            near = np.bitwise_count(held[:, None] ^ values[None, at:at + BLOCK]) <= radius
            i, j = np.nonzero(near)
            if not len(i):
                continue
            first = np.full(near.shape[1], len(held))
            np.minimum.at(first, j, i)
            hit = np.flatnonzero(first < len(held))
            edges_a.append(values[at + hit])
            edges_b.append(held[first[hit]])
            pairs = np.unique(i * np.int64(len(held)) + first[j])
            x, y = pairs // len(held), pairs % len(held)
            while True:         # smallest label along the matches, with the roots so far
                low = np.minimum(label[x], label[y])
                new = label.copy()
                for side in (x, y, label[x], label[y]):
                    np.minimum.at(new, side, low)
                new = new[new]
                if np.array_equal(new, label):
                    break
                label = new

    def flush():
        if edges_a:
            a, b = np.concatenate(edges_a), np.concatenate(edges_b)
            edges_a.clear()
            edges_b.clear()
            keep = a != b
            if keep.any():
                yield batch_of(schema, [a[keep].view(np.int64), b[keep].view(np.int64)])

    for batch in batches:
        g = batch.column("g").to_numpy()
        role = batch.column("role").to_numpy()
        fp = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
        edge = np.flatnonzero((g[1:] != g[:-1]) | (role[1:] != role[:-1])) + 1
        for a, b in zip(np.r_[0, edge].tolist(), np.r_[edge, len(g)].tolist()):
            if a == b:
                continue
            if g[a] != group:
                if isinstance(held, np.ndarray):
                    close()
                group, held, label = g[a], [], None
            if role[a] == 0:
                held.append(fp[a:b])
                continue
            if not isinstance(held, np.ndarray):
                held = np.concatenate(held) if held else np.zeros(0, np.uint64)
                label = np.arange(len(held))
            if len(held):
                compare(fp[a:b])
        yield from flush()
    if isinstance(held, np.ndarray):
        close()
    yield from flush()


def near_edges(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) fingerprints within ``radius`` bits that span every group; ``fps``: distinct ``fp``."""
    counted = fps.select("fp", *[c.alias(f"p{i}") for i, c in enumerate(_part_counts(F.col("fp")))])
    own = _tile([F.col(f"p{i}") for i in range(3)])
    counted = counted.withColumn("tile", own)
    # At most 23 * 22 * 22 rows, whatever the table: safe to broadcast.
    pieces = counted.groupBy("tile").agg(F.ceil(F.count("*") / tile).cast("int").alias("pieces"))
    held = counted.join(F.broadcast(pieces), "tile").select(
        "tile", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int").alias("piece"),
        F.lit(0).alias("role"), "fp")
    # Part counts of the tiles within the radius that do not come after the own tile.
    steps = [d for d in product(range(-radius, radius + 1), repeat=3) if sum(map(abs, d)) <= radius]
    steps = [d for d in steps if (d[0] * 32 + d[1]) * 32 + d[2] <= 0]
    near = F.array(*[_tile([F.col(f"p{i}") + F.lit(d[i]) for i in range(3)]) for d in steps])
    past = (counted.select("fp", F.explode(near).alias("tile")).join(F.broadcast(pieces), "tile")
            .select("tile", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
                    F.lit(1).alias("role"), "fp"))
    rows = held.unionByName(past).select(
        (F.col("tile").cast("long") * (1 << 32) + F.col("piece")).alias("g"), "role", "fp")
    return rows.repartition("g").sortWithinPartitions("g", "role", "fp").mapInArrow(
        lambda it: _forest(it, radius), "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS, seed: int = HASH_SEED) -> DataFrame:
    """(_id, _th, fp, _group): the smallest inner id reachable through links."""
    rows = cut(with_fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    firsts = rows.groupBy("fp").agg(F.min("_id").alias("low"))
    groups = components(near_edges(firsts.select("fp"), radius)).select(
        F.col("vertex").alias("fp"), F.col("component").alias("c"))
    by_fp = firsts.join(groups, "fp", "left").withColumn("c", F.coalesce("c", "fp"))
    lows = by_fp.groupBy("c").agg(F.min("low").alias("_group"))
    named = by_fp.join(lows, "c").select("fp", "_group")
    return rows.join(named, "fp").select("_id", "_th", "fp", "_group")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each group stays: the one with the group's smallest id."""
    groups = near_groups(docs, id_col, text_col, **how)
    # The smallest id is unique unless ids repeat; then the smallest text hash stays.
    stay = groups.where("_id = _group").groupBy("_group").agg(F.min("_th").alias("_th")).select(
        F.col("_group").alias("_id"), "_th")
    names = docs.columns
    whole = docs.select(F.struct("*").alias("_doc"), id_of(id_col).alias("_id"),
                        F.xxhash64(text_of(text_col)).alias("_th"))
    one = Window.partitionBy("_id", "_th").orderBy(F.lit(1))
    return (whole.join(stay, ["_id", "_th"]).withColumn("_rn", F.row_number().over(one)).where("_rn = 1")
            .select(*[F.col("_doc").getField(n).alias(n) for n in names]))


def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of every document."""
    return near_groups(documents(spark, sf_dir)).select(
        real_id("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        real_id("_group").alias("component_id"))
