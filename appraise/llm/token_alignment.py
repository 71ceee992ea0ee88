"""Aligning the tokens that two tokenizers make of the same text.

Both tokenizers cut the same bytes (a space, then the text). Where a token of each
ends at one byte, a group ends; tokens of a group whose byte ranges overlap are linked.
For every linked pair of ids the documents that hold it are counted over the corpus,
and each document's links are summed up by these counts.

Method: diagonal run skipping. At the current index shift between the two end arrays
a run of one-to-one tokens is jumped by comparing a few ends, then slices of 8, 16, 32, ...
of them, then of half the length again until not even one more end agrees. The tokens behind
it are an irregular group: it is walked end by end, which yields its links, until
the ends meet again; the difference of the tokens it consumed updates the shift.

Spark: a task tokenises its documents in chunks of about ``CHUNK`` bytes of text and
writes, per chunk, the distinct id pairs with the number of its documents that hold them, and, per
document, its pairs as places in that list. Pair counts are a folded sum over
the chunks' lists; the highest count of each first id is a table no longer than that
tokenizer's vocabulary. Each chunk then gets the counts of its own pairs back, and its
documents follow them through one task, so neither links nor pair tables ever meet in one place and
no link crosses a shuffle as a row of its own. A chunk holds one document at least,
however long.

Defined results: a text that is null, empty, or that the second tokenizer alters
(its joined pieces differ from the bytes) has no tokens: zeros and an empty string
for the hash. Rows are documents: repeated rows and rows with a null id count and
are returned one by one. Ties for the highest count all count as best. An empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm.common import batch_of, cut, documents, id_of, real_id, shuffle_width, text_of
from appraise.llm.packing import _encoder, default_ranks

CHUNK = 4 << 20             # bytes of text a chunk is closed at


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _ranked(path: str):
    """Tokenizer by ranks; bytes, sizes and decimal forms of its ids."""
    encoder = _encoder(path)
    entries = [b""] * encoder.n_vocab
    for token in encoder.token_byte_values():
        entries[encoder.encode_single_token(token)] = token
    sizes = np.array([len(e) for e in entries], np.int64)
    return encoder, entries, sizes, _names(len(entries), ","), _names(len(entries), "|")


@lru_cache(maxsize=2)
def _pieced(path: str):
    """Tokenizer by pieces; bytes, sizes and decimal forms of its ids."""
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i)
               else pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]
    sizes = np.array([len(e) for e in entries], np.int64)
    return pieces, entries, sizes, _names(len(entries), ","), _names(len(entries), ";")


PROBE = 8                   # ends compared one by one before slices are


@dataclass
class Aligned:
    """Groups of two end arrays: their last tokens on either side, and the links as places in a and in b."""
    last_a: np.ndarray
    last_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @property
    def n_groups(self) -> int:
        return int(self.last_a.sum())


def diagonal_runs(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Align two rising arrays that end at the same value.

    Runs of one-to-one tokens and irregular groups take turns; a run is kept as its
    bounds, an irregular group by its links and last tokens.
    """
    raw_a, raw_b = ends_a.astype("<u8").tobytes(), ends_b.astype("<u8").tobytes()
    a, b = ends_a.tolist(), ends_b.tolist()
    run_from, run_to, run_shift, last_a, last_b, link_a, link_b = [], [], [], [], [], [], []
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            start, shift = i, j - i
            i += 1
            stop = min(start + PROBE, n)
            while i < stop and a[i] == b[i + shift]:
                i += 1
            if i == stop:
                length, growing = PROBE, True
                while length and i < n:
                    here, there = 8 * i, 8 * (i + shift)
                    if raw_a[here:here + 8 * length] == raw_b[there:there + 8 * length]:
                        i = min(i + length, n)
                        length = 2 * length if growing else length // 2
                    else:
                        length, growing = length // 2, False
            run_from.append(start)
            run_to.append(i)
            run_shift.append(shift)
            j = i + shift
            continue
        while True:                     # the shift no longer holds: walk to the next common end
            link_a.append(i)
            link_b.append(j)
            x, y = a[i], b[j]
            if x < y:
                i += 1
            elif y < x:
                j += 1
            else:
                last_a.append(i)
                last_b.append(j)
                i += 1
                j += 1
                break
    start, size = np.array(run_from, np.int64), np.array(run_to, np.int64) - np.array(run_from, np.int64)
    single = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
    paired = single + np.repeat(np.array(run_shift, np.int64), size)
    is_last_a, is_last_b = np.zeros(n, bool), np.zeros(len(b), bool)
    is_last_a[single] = is_last_a[last_a] = is_last_b[paired] = is_last_b[last_b] = True
    return Aligned(is_last_a, is_last_b, np.concatenate([single, np.array(link_a, np.int64)]),
                   np.concatenate([paired, np.array(link_b, np.int64)]))


def _names(size: int, end: str) -> np.ndarray:
    """Every id in decimal with one character behind it, padded with zero bytes."""
    return np.array([f"{i}{end}".encode() for i in range(size)])


def group_text(found: Aligned, a: np.ndarray, b: np.ndarray, names) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: every token laid at its place, the padding taken out."""
    a_more, a_last, b_more, b_last = names
    before_b = np.concatenate([[0], np.flatnonzero(found.last_b) + 1])      # tokens of b up to each group
    upto_a = np.flatnonzero(found.last_a) + 1
    group_a = np.cumsum(found.last_a) - found.last_a
    group_b = np.cumsum(found.last_b) - found.last_b
    out = np.zeros(len(a) + len(b), f"S{max(x.dtype.itemsize for x in names)}")
    out[np.arange(len(a)) + before_b[group_a]] = np.where(found.last_a, a_last[a], a_more[a])
    out[np.arange(len(b)) + upto_a[group_b]] = np.where(found.last_b, b_last[b], b_more[b])
    letters = out.view(np.uint8)
    return letters[letters != 0].tobytes()[:-1]


def _document(text: str, ids_b: list[int], first, second):
    """(n_a, n_b, n_groups, groups, sorted pair codes, their multiplicities) of one text."""
    whole = b" " + text.encode()
    encoder, entries_a, sizes_a, *names_a = first
    _, entries_b, sizes_b, *names_b = second
    ids_a = encoder.encode_ordinary(" " + text)
    if b"".join([entries_b[t] for t in ids_b]) != whole or b"".join([entries_a[t] for t in ids_a]) != whole:
        return None
    a, b = np.array(ids_a), np.array(ids_b)
    found = diagonal_runs(np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b]))
    codes, times = np.unique(a[found.link_a] * len(entries_b) + b[found.link_b], return_counts=True)
    return len(a), len(b), found.n_groups, group_text(found, a, b, names_a + names_b), codes, times


ALIGNED = pa.schema([("chunk", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("sha", pa.string()), ("shown", pa.string()),
                     ("steps", pa.binary()), ("times", pa.binary()),
                     ("codes", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))])
ALIGNED_DDL = ("chunk long, id long, n_a long, n_b long, n_groups long, n_links long, sha string, shown string, "
               "steps binary, times binary, codes array<long>, held array<int>")


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 1, 2, 4 or 8 bytes; the first byte says which."""
    kind = 0 if not len(x) else next(k for k in range(4) if k == 3 or int(x.max()) < 1 << (8 << k))
    return bytes([kind]) + x.astype(f"<u{1 << kind}").tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{1 << x[0]}", offset=1).astype(np.int64)


def _align(ranks: str, model: str, chunk_bytes: int, shown: bool):
    def finish(chunk, rows):
        pairs = [r[6] for r in rows if r[6] is not None]
        codes, held = np.unique(np.concatenate(pairs), return_counts=True) if pairs else (np.zeros(0, np.int64),) * 2
        for doc, n_a, n_b, n_groups, sha, text, mine, times in rows:
            if mine is None:
                yield (chunk, doc, 0, 0, 0, 0, "", text, None, None, None, None)
                continue
            steps = np.diff(np.searchsorted(codes, mine), prepend=0)
            yield (chunk, doc, n_a, n_b, n_groups, int(times.sum()), sha, text, _packed(steps), _packed(times), None, None)
        if len(codes):
            yield (chunk, *[None] * 9, codes, held.astype(np.int32))

    def run(batches):
        first, second = _ranked(ranks), _pieced(model)
        chunk, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            texts = batch.column("text")
            for s in range(0, len(ids), 256):
                part = texts.slice(s, 256).to_pylist()
                for doc, text, ids_b in zip(ids[s:s + 256], part, second[0].encode(part, num_threads=1)):
                    found = _document(text, ids_b, first, second) if text else None
                    if found is None:
                        rows.append((doc, 0, 0, 0, "", "" if shown else None, None, None))
                    else:
                        n_a, n_b, n_groups, groups, codes, times = found
                        rows.append((doc, n_a, n_b, n_groups, hashlib.sha256(groups).hexdigest(),
                                     groups.decode() if shown else None, codes, times))
                    size += len(text)
                    if size >= chunk_bytes or len(rows) >= 1 << 14:
                        yield batch_of(ALIGNED, list(zip(*finish(chunk, rows))))
                        chunk, rows, size = chunk + 1, [], 0
        if rows:
            yield batch_of(ALIGNED, list(zip(*finish(chunk, rows))))
    return run


RESULT = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                    ("sha", pa.string()), ("shown", pa.string())])
RESULT_DDL = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, sha string, shown string"


def _looked_up(batches):
    """Rows come by (chunk, place): a chunk's pair counts in the order of its list, then its documents."""
    chunk, values, counts, best = None, [], None, None
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        edges = np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1)).tolist() + [len(chunks)]
        out = []
        for s, e in zip(edges, edges[1:]):
            if chunks[s] != chunk:
                chunk, values, counts = int(chunks[s]), [], None
            part = batch.slice(s, e - s)
            value = part.column("value")
            pairs = len(part) - value.null_count
            if pairs:
                values.append(value.slice(0, pairs).to_numpy(zero_copy_only=False).astype(np.int64))
            if pairs == len(part):
                continue
            if counts is None:
                joined = np.concatenate(values) if values else np.zeros(0, np.int64)
                counts, best, values = joined >> 1, joined & 1, []
            rows = part.slice(pairs)
            for doc, n_a, n_b, n_groups, n_links, sha, shown, steps, times in zip(*(rows.column(c).to_pylist() for c in (
                    "id", "n_a", "n_b", "n_groups", "n_links", "sha", "shown", "steps", "times"))):
                n_best = total = 0
                if steps is not None:
                    at, many = np.cumsum(_unpacked(steps)), _unpacked(times)
                    n_best, total = int(many @ best[at]), int(many @ counts[at])
                out.append((doc, n_a, n_b, n_groups, n_links, n_best, total, sha, shown))
        if out:
            yield batch_of(RESULT, list(zip(*out)))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
          model: str | None = None, chunk_bytes: int = CHUNK, shown: bool = False) -> DataFrame:
    """One row per document; ``shown`` adds the groups themselves.

    ``ranks`` and ``model`` are the tokenizers' paths, the same on every worker.
    """
    spark = docs.sparkSession
    ranks, model = ranks or default_ranks(), model or default_pieces()
    aligned = cut(docs.select(id_of(id_col).alias("id"), text_of(text_col).alias("text"))
                  .mapInArrow(_align(ranks, model, chunk_bytes, shown), ALIGNED_DDL), "aligned")
    width = len(_pieced(model)[1])
    own = aligned.where("codes IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("codes", "held")).alias("place", "p")) \
        .select("chunk", "place", F.col("p.codes").alias("code"), F.col("p.held").alias("held"))
    pairs = cut(own.groupBy("code").agg(F.sum("held").cast("long").alias("count")), "pairs")
    first = F.floor(F.col("code") / width).cast("long")
    top = pairs.groupBy(first.alias("first")).agg(F.max("count").alias("top"))     # at most one row per id
    valued = pairs.withColumn("first", first).join(F.broadcast(top), "first").select(
        "code", (F.col("count") * 2 + (F.col("count") == F.col("top")).cast("long")).alias("value"))
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "sha", "shown", "steps", "times"]
    lists = own.join(valued, "code").select("chunk", F.col("place").cast("long").alias("place"), "value")
    rows = aligned.where("codes IS NULL").select("chunk", F.lit((1 << 62)).alias("place"), F.lit(None).cast("long").alias("value"), *names)
    met = lists.unionByName(rows, allowMissingColumns=True).repartition(shuffle_width(spark), "chunk")
    out = met.sortWithinPartitions("chunk", "place").mapInArrow(_looked_up, RESULT_DDL)
    extra = [F.col("shown").alias("groups")] if shown else []
    return out.select(real_id("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("sha").alias("groups_sha256"), *extra)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte and piece tokens of every whole text, aligned; links summed up by corpus-wide counts."""
    return align(documents(spark, sf_dir))
