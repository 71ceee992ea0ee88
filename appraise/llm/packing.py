"""Packing documents into token sequences along a space-filling curve.

Documents become token ids; their hashed token vectors are projected to a few
dimensions and the Hilbert key of the projected point orders the table. A
document's full-length pieces are sequences by themselves; what remains of it
is packed with the remainders of its neighbours along the curve. A range of the
curve is one task, which packs without gaps while its rows stream through:
remainders are laid end to end and cut at the sequence length, and the last ones
of a range are cut at powers of two, so no sequence needs padding beyond its own
length.

Ids are those of the tokenizer file ``byte_bpe_50k.json``, whose added tokens are
matched inside the text; the same vocabulary as ranks (``byte_bpe_50k.tiktoken``)
with the added tokens of that file gives the same ids several times faster and is
what the tasks use (the tests compare the two). Null text is the empty
document: one end id. Null ids are packed and returned as null. Very long texts are cut
into as many pieces as they need. Documents of equal curve keys are ordered by id, hash of
the remainder and length, then by a row number, so a third of the table being one
empty text fills many ranges. Repeated rows are packed as often as they are listed. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm.common import (batch_of, binary_rows, cut, documents, id_of, real_id,
                                 shuffle_width, text_of)

LENGTH = 1024
END_ID = 0
DIMENSIONS = 4
BITS = 12               # per dimension: keys have 48 bits


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """Tokens of the tokenizer file that are matched in the text before it is split into words."""
    import json

    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that look at their surroundings are not supported")
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=2)
def _encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=added_tokens())


def projection(vocabulary: int = 1 << 16, dims: int = DIMENSIONS) -> np.ndarray:
    """Fixed pseudo-random directions in {-1, 1} per hashed id (splitmix bits)."""
    x = np.arange(vocabulary, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    bits = (x[:, None] >> np.arange(dims, dtype=np.uint64)) & np.uint64(1)
    return bits.astype(np.float32) * 2 - 1


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows) in the cube of ``bits`` bits a dimension."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:                               # undo excess rotation, from the high bits down
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):                      # Gray code
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray], table: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key per document: projected term counts over their norm, squashed to the cube."""
    at = np.empty((len(ids), table.shape[1]))
    for i, doc in enumerate(ids):
        terms, counts = np.unique(doc, return_counts=True)
        w = np.sqrt(counts)                    # damps very frequent ids
        at[i] = (w @ table[terms & (len(table) - 1)]) / np.sqrt(counts.sum())
    cells = (1 / (1 + np.exp(-at)) * (1 << bits)).astype(np.int64)
    return hilbert(np.clip(cells, 0, (1 << bits) - 1), bits)


TOKENS = pa.schema([("_id", pa.int64()), ("_key", pa.int64()), ("_n", pa.int64()),
                    ("_crcs", pa.list_(pa.int64())), ("_tail", pa.binary())])
TOKENS_DDL = "_id long, _key long, _n long, _crcs array<long>, _tail binary"


def _tokenise(path: str, length: int):
    def run(batches):
        encoder, table = _encoder(path), projection()
        added = added_tokens()

        def encode(text):
            # The texts between added tokens are split and merged by themselves, as the tokenizer does.
            if any(t in text for t in added):
                return encoder.encode(text, allowed_special="all")
            return encoder.encode_ordinary(text)

        for b in batches:
            ids = [np.array(encode(t.decode()) + [END_ID], np.uint32) for t in binary_rows(b.column("_text"))]
            crcs, tails = [], []
            for doc in ids:
                full = len(doc) // length * length
                crcs.append([zlib.crc32(doc[s:s + length].astype("<u4")) for s in range(0, full, length)])
                tails.append(doc[full:].astype("<u2" if doc.max() < 65536 else "<u4").tobytes()
                             if full < len(doc) else b"")
            yield batch_of(TOKENS, [b.column("_id"), curve_keys(ids, table), [len(d) for d in ids], crcs, tails])
    return run


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")


def _tail_ids(tail: bytes, n: int) -> np.ndarray:
    return np.frombuffer(tail, "<u2" if len(tail) == 2 * n else "<u4").astype("<u4")


def _cut_open(held: list[tuple], left: int, seq: int):
    """Pieces of the last remainders of a range, laid into sequences of powers of two: no padding."""
    room, at = 0, 0
    for doc, n, start, ids in held:
        done = 0
        while done < len(ids):
            if at == room:
                room, at, seq = 1 << (left.bit_length() - 1), 0, seq + 1
                left -= room
            take = min(room - at, len(ids) - done)
            yield doc, start + done, take, zlib.crc32(ids[done:done + take].tobytes()), n, seq, at
            done, at = done + take, at + take


def pack_range(rows, length: int, first: int):
    """Pieces of one range of the curve; rows are (id, n, crcs, tail) in curve order.

    Rows stream through: only the remainders of the open sequence, under
    ``length`` ids, are held, since its own length is known when the range ends.
    """
    seq, held, size = first, [], 0
    for doc, n, crcs, tail in rows:
        for i, crc in enumerate(crcs):
            yield doc, i * length, length, crc, n, seq, 0
            seq += 1
        start = len(crcs) * length
        if start == n:
            continue
        ids = _tail_ids(tail, n - start)
        take = min(length - size, len(ids))
        held.append((doc, n, start, ids[:take]))
        size += take
        if size == length:
            at = 0
            for d, m, s, part in held:
                yield d, s, len(part), zlib.crc32(part.tobytes()), m, seq, at
                at += len(part)
            seq += 1
            held = [(doc, n, start + take, ids[take:])] if take < len(ids) else []
            size = len(ids) - take
    yield from _cut_open(held, size, seq - 1)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         ranks: str | None = None, ranges: int | None = None) -> DataFrame:
    """One row per piece; sequence ids are unique, ranges of the curve one after the other.

    ``ranks`` is the tokenizer's path (the same on every worker), ``ranges`` the
    number of curve ranges, each packed by one task; by default twice the
    session's shuffle partitions.
    """
    spark, ranks = docs.sparkSession, ranks or default_ranks()
    tokens = cut(docs.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
                 .mapInArrow(_tokenise(ranks, length), TOKENS_DDL), "tokens")
    # Whole, so that a task that runs again packs alike; rows equal in all but their number still spread over ranges.
    order = ("_key", "_id", F.xxhash64("_tail"), "_n", "_row")
    ordered = tokens.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(ranges or 2 * shuffle_width(spark), *order).sortWithinPartitions(*order)

    def run(batches):
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("_id", "_n", "_crcs", "_tail"))))
        buffer = []
        for piece in pack_range(rows, length, TaskContext.get().partitionId() << 40):
            buffer.append(piece)
            if len(buffer) == 1 << 15:
                yield batch_of(PIECES, [list(c) for c in zip(*buffer)])
                buffer = []
        if buffer:
            yield batch_of(PIECES, [list(c) for c in zip(*buffer)])

    return ordered.mapInArrow(run, PIECES_DDL).withColumn("doc_id", real_id("doc_id"))


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document, packed along the Hilbert curve."""
    return pack(documents(spark, sf_dir))
