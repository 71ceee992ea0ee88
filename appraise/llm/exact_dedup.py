"""Exact deduplication with a cuckoo-filter index over live digests.

Each task folds its rows into an index: a cuckoo filter (16-bit fingerprints,
four slots a bucket, two candidate buckets) whose slots point into a key store.
The digest stands for the content: a filter hit is verified against the whole SHA-256
of the normalised text that the slot's bucket stores, not against the text itself. An
entry takes about 300 bytes of a task's memory, so a partition of a million live
digests some 300 MB. A better row deletes the old live entry and inserts itself; when an insertion
finds no free slot the filter doubles and is rebuilt from the stored keys.

Two rounds: every input partition folds its own rows first (so a group of
copies holding a third of the table leaves one row per partition), then the
partial winners meet by digest and are folded by the same index.

Null texts count as empty; all empty texts are one group. A null id is the smallest
and is returned as null. Long texts are hashed whole, in Spark. Of rows repeated in
full, one is kept. An empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from appraise.llm.common import SPACES, batch_of, cut, documents, id_of, real_id, text_of

SLOTS = 4
MAX_KICKS = 200
FLUSH_AT = 1 << 18      # live digests a first-round index holds before it is emitted


class CuckooIndex:
    """Digest -> (points, id, row, size) of the live row, behind a cuckoo filter."""

    def __init__(self, buckets: int = 256):
        self.keys: list[bytes | None] = []      # stored keys, by record
        self.rows: list[tuple | None] = []
        self.free: list[int] = []
        self.live = 0
        self._make(buckets)

    def _make(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * buckets * SLOTS))
        self.records = array("q", bytes(8 * buckets * SLOTS))

    def _places(self, digest: bytes) -> tuple[int, int]:
        fp = int.from_bytes(digest[:2], "big") or 1
        return fp, int.from_bytes(digest[2:10], "big") & self.mask

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x5BD1E995)) & self.mask

    def _slot(self, digest: bytes) -> int:
        fp, b = self._places(digest)
        for bucket in (b, self._other(b, fp)):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[s] == fp and self.keys[self.records[s]] == digest:
                    return s
        return -1

    def find(self, digest: bytes) -> tuple | None:
        s = self._slot(digest)
        return None if s < 0 else self.rows[self.records[s]]

    def delete(self, digest: bytes) -> bool:
        s = self._slot(digest)
        if s < 0:
            return False
        record = self.records[s]
        self.prints[s] = 0
        self.keys[record] = self.rows[record] = None
        self.free.append(record)
        self.live -= 1
        return True

    def insert(self, digest: bytes, row: tuple) -> None:
        if self.free:
            record = self.free.pop()
            self.keys[record], self.rows[record] = digest, row
        else:
            record = len(self.keys)
            self.keys.append(digest)
            self.rows.append(row)
        self.live += 1
        if not self._put(digest, record):
            self._grow()

    def _put(self, digest: bytes, record: int) -> bool:
        fp, b = self._places(digest)
        for bucket in (b, self._other(b, fp)):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[s]:
                    self.prints[s], self.records[s] = fp, record
                    return True
        for kick in range(MAX_KICKS):
            s = b * SLOTS + kick % SLOTS
            fp, self.prints[s] = self.prints[s], fp
            record, self.records[s] = self.records[s], record
            b = self._other(b, fp)
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.prints[s]:
                    self.prints[s], self.records[s] = fp, record
                    return True
        return False

    def _grow(self) -> None:
        """Rebuild from the stored keys with twice the buckets, until all fit."""
        buckets = 2 * (self.mask + 1)
        while True:
            self._make(buckets)
            if all(self._put(k, i) for i, k in enumerate(self.keys) if k is not None):
                return
            buckets *= 2

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        return ((k, r) for k, r in zip(self.keys, self.rows) if k is not None)


def offer(index: CuckooIndex, digest: bytes, points: int, doc: int, row: int, size: int) -> None:
    """Fold one row in: the most code points stay live, then the smallest id, then row."""
    live = index.find(digest)
    if live is None:
        index.insert(digest, (points, doc, row, size))
        return
    best = min((-live[0], live[1], live[2]), (-points, doc, row))
    index.delete(digest)
    index.insert(digest, (-best[0], best[1], best[2], live[3] + size))


FOLDED = pa.schema([("digest", pa.binary()), ("points", pa.int64()), ("keep", pa.int64()),
                    ("keep_row", pa.int64()), ("size", pa.int64())])
FOLDED_DDL = "digest binary, points long, keep long, keep_row long, size long"


def _fold(flush_at: int | None):
    def run(batches):
        index = CuckooIndex()

        def out():
            items = list(index.items())
            for at in range(0, len(items), 8192):
                part = items[at:at + 8192]
                yield batch_of(FOLDED, [[k for k, _ in part], *([r[i] for _, r in part] for i in range(4))])

        for b in batches:
            for row in zip(*(b.column(n).to_pylist() for n in FOLDED.names)):
                offer(index, *row)
            if flush_at and index.live >= flush_at:
                yield from out()
                index = CuckooIndex()
        yield from out()
    return run


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _n, _sha): inner id, code points, hex digest of the text without white space."""
    return docs.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_t")).select(
        "_id", F.length("_t").cast("long").alias("_n"),
        F.sha2(F.regexp_replace("_t", SPACES + "+", ""), 256).alias("_sha"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest of (digest, points, doc, row): the live row and the group's size."""
    first = rows.select("digest", "points", F.col("doc").alias("keep"),
                        F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("size"))
    partial = first.mapInArrow(_fold(FLUSH_AT), FOLDED_DDL)
    return partial.repartition("digest").mapInArrow(_fold(None), FOLDED_DDL)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = cut(digests(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()),
               "digests")
    best = winners(rows.select(F.unhex("_sha").alias("digest"), F.col("_n").alias("points"),
                               F.col("_id").alias("doc"), F.col("_row").alias("row")))
    best = best.select(F.lower(F.hex("digest")).alias("_sha"), "keep", "keep_row", "size")
    return rows.join(best, "_sha").select(
        real_id("_id").alias("doc_id"), real_id("keep").alias("keep_id"),
        F.col("size").alias("group_size"), (F.col("_row") == F.col("keep_row")).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns: one row of each group of equal texts."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_kid"), F.col("text_sha256").alias("_ksha"))
    names = docs.columns
    whole = docs.select(F.struct("*").alias("_doc"), id_of(id_col).alias("_kid"),
                        F.length(text_of(text_col)).alias("_kn"),
                        F.sha2(F.regexp_replace(text_of(text_col), SPACES + "+", ""), 256).alias("_ksha"))
    # Of rows that share id and text (repeated rows) one stays.
    one = Window.partitionBy("_kid", "_ksha").orderBy(F.desc("_kn"))
    return (whole.join(kept, ["_kid", "_ksha"]).withColumn("_rn", F.row_number().over(one))
            .where("_rn = 1").select(*[F.col("_doc").getField(n).alias(n) for n in names]))


def op10_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuckoo-filter exact dedup over every row of documents."""
    return exact_groups(documents(spark, sf_dir))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s
  FROM documents),
g AS (
  SELECT doc_id, s,
         first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY s) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM g
"""
