"""Substring deduplication of words by level-wise doubling.

Windows start at 5 words: seeds (see ``passages``) that occur once are dropped,
and only regions whose seed has different regions go on. Each is extended to the
10 words that all its windows share (after the seed, or around it for the
windows that end early); those that occur once are dropped by a count with
map-side sums and a semi join. The survivors' windows are extended to 20 words
and meet by a 128-bit hash of them; all but the earliest window of a group
remove their words. A level without candidates leaves nothing to the next.

No level keeps a group together in memory: a 5- or 10-word run that a third of
all documents share only costs counts, and of a repeated 20-word window one row
a task and flush crosses the last exchange as its first, the others as settled.

Null texts and texts without words have nothing removed. Repeated rows (same id,
same text) start at the same place, so neither is earlier than the other. Null
ids sort first; rows of one id but different texts are ordered by place, then by the text's
hash. Long texts are cut into segments of windows. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm import passages as P
from appraise.llm.common import batch_of, binary_rows, cut, documents, keyed, real_id

LENGTH = 20
FIRST = 5


def word_symbols(text: bytes) -> np.ndarray:
    """A 64-bit hash per word."""
    a = np.frombuffer(text, np.uint8)
    gap = (a == 32) | ((a >= 9) & (a <= 13))
    begins = ~gap
    begins[1:] &= gap[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64)
    a, gap, starts = a[starts[0]:], gap[starts[0]:], starts - starts[0]
    inside = np.arange(len(a)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(a)]))))
    pw = P.powers(P.BASE, int(inside.max()) + 1)
    return P.mixed(np.add.reduceat(np.where(gap, np.uint64(0), P.BYTE_HASH[a]) * pw[inside], starts))


RESULT, WAITING, REGION = 0, 1, 2
MID = pa.schema([
    ("kind", pa.int32()), ("_id", pa.int64()), ("_th", pa.int64()), ("text", pa.binary()),
    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("n", pa.int64()), ("removed", pa.int64()), ("sha", pa.string()),
    ("run", pa.int64()), ("body", pa.binary()), ("lo", pa.int64())])
MID_DDL = ("kind int, _id long, _th long, text binary, starts array<long>, ends array<long>, n long, "
           "removed long, sha string, run long, body binary, lo long")


def _hash(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "big", signed=True)


def doubled(words: list[bytes], lo: int, most: int, least: int, length: int, first: int):
    """(hash of a run twice as long as the seed, first window, words) of a region's windows.

    Windows that end far enough behind the seed share the run that starts with
    it; the others start early enough to share the run that ends with it. The
    run's place in the window is told from its offset, which the hash includes.
    """
    at, size = lo + most, 2 * first
    for a, b, start in ((least, min(most, length - size), at), (max(least, length - size + 1), most, at + first - size)):
        if a <= b:
            yield _hash(words[start:start + size]) ^ (start - at), at - b, b" ".join(words[at - b:at - a + length])


def cut_out(words: list[bytes], starts, ends) -> tuple[int, str]:
    """(words removed, hex digest of the others joined by a space)."""
    kept, at = [], 0
    for s, e in zip(starts, ends):
        kept += words[at:s]
        at = e
    kept += words[at:]
    return len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _regions(length: int, first: int):
    def run(batches):
        for b in batches:
            rows = []
            for doc, th, found, text in zip(b.column("_id").to_pylist(), b.column("_th").to_pylist(),
                                            b.column("_places").to_pylist(), binary_rows(b.column("_z"))):
                found, words = P.read_places(found), P.unzip(text).split()
                starts, ends = P.settled_spans(found, length)
                asked = False
                for status, lo, most, least in zip(*(x.tolist() for x in found)):
                    if status != P.ASK:
                        continue
                    asked = True
                    rows += [{"kind": REGION, "_id": doc, "_th": th, "run": h, "lo": start, "body": body}
                             for h, start, body in doubled(words, lo, most, least, length, first)]
                row = {"kind": WAITING if asked else RESULT, "_id": doc, "_th": th, "n": len(words)}
                if asked:
                    row |= {"text": text, "starts": starts.tolist(), "ends": ends.tolist()}
                else:
                    row |= dict(zip(("removed", "sha"), cut_out(words, starts.tolist(), ends.tolist())))
                rows.append(row)
            yield batch_of(MID, [[r.get(n) for r in rows] for n in MID.names])
    return run


WINDOWS = pa.schema([("h", pa.int64()), ("h2", pa.int64()), ("_id", pa.int64()), ("_th", pa.int64()),
                     ("s", pa.int64()), ("late", pa.bool_())])
WINDOWS_DDL = "h long, h2 long, _id long, _th long, s long, late boolean"
LATE = pa.schema([WINDOWS.field(n) for n in ("_id", "_th", "s")])
FLUSH_AT = 1 << 19          # windows a task folds at a time


def _fold(held: list[tuple]) -> list[np.ndarray]:
    """Of the windows with equal words the earliest stays open, the others are late already."""
    h, h2, doc, th, s = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((th, s, doc, h2, h))
    h, h2, doc, th, s = (c[order] for c in (h, h2, doc, th, s))
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = (doc != doc[first]) | (s != s[first])
    again = ~new & np.concatenate(([False], (doc[1:] == doc[:-1]) & (s[1:] == s[:-1]) & (th[1:] == th[:-1])))
    # Late windows only travel to their document: spread them.
    h = np.where(late, P.mixed((h2 ^ doc * 3 ^ s * 5).view(np.uint64)).view(np.int64), h)
    return [c[~again] for c in (h, h2, doc, th, s, late)]


def _windows(length: int):
    """Every window of the surviving runs, by a 128-bit hash of its words, folded within the task."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            rows = []
            for doc, th, lo, body in zip(*(b.column(c).to_pylist() for c in ("_id", "_th", "lo")),
                                         binary_rows(b.column("body"))):
                starts = [0, *accumulate(len(w) + 1 for w in body.split())]
                ends = [x - 1 for x in starts[1:]]
                rows += [(hashlib.blake2b(body[x:y], digest_size=16).digest(), doc, th, lo + i)
                         for i, (x, y) in enumerate(zip(starts, ends[length - 1:]))]
            if rows:
                digest, *rest = zip(*rows)
                held.append((*np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2).T,
                             *(np.array(c, np.int64) for c in rest)))
                n += len(rows)
            if n >= FLUSH_AT:
                yield batch_of(WINDOWS, _fold(held))
                held, n = [], 0
        if n:
            yield batch_of(WINDOWS, _fold(held))
    return run


def _late(batches):
    """Rows sorted by (h, h2, _id, s): the windows that are not the earliest of their words."""
    last = None                                # words and place of the earliest of the latest group
    for b in batches:
        h, h2, doc, th, s = (b.column(c).to_numpy() for c in ("h", "h2", "_id", "_th", "s"))
        late = b.column("late").to_numpy(zero_copy_only=False)
        use = np.flatnonzero(~late)
        x = [c[use] for c in (h, h2, doc, s)]
        if last is not None:
            x = [np.concatenate(([v], c)) for v, c in zip(last, x)]
        if len(x[0]):
            new = np.concatenate(([True], (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])))
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            behind = (x[2] != x[2][first]) | (x[3] != x[3][first])
            late[use] = behind[len(behind) - len(use):]
            last = [c[first[-1]] for c in x]
        yield batch_of(LATE, [doc[late], th[late], s[late]])


def _finish(length: int):
    schema = pa.schema([(n, MID.field(n).type) for n in ("_id", "_th", "n", "removed", "sha")])

    def run(batches):
        for b in batches:
            rows = []
            for doc, th, starts, ends, found, text in zip(
                    *(b.column(c).to_pylist() for c in ("_id", "_th", "starts", "ends", "_found")),
                    binary_rows(b.column("text"))):
                found, words = np.array(found or [], np.int64), P.unzip(text).split()
                s, e = P.merged(np.concatenate((np.array(starts, np.int64), found)),
                                np.concatenate((np.array(ends, np.int64), found + length)))
                rows.append((doc, th, len(words), *cut_out(words, s.tolist(), e.tolist())))
            yield batch_of(schema, [list(c) for c in zip(*rows)] if rows else [[]] * 5)
    return run


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """Per document: _id, _th, n, removed, sha (of the words left, joined by a space).

    Words covered by a ``length``-word window that also starts earlier go.
    """
    if length < 3 * first:
        raise ValueError("windows of fewer than three seeds' words are not supported")
    whole = keyed(docs, id_col, text_col)
    placed = P.with_places(whole, word_symbols, first, length, earliest=True)
    mid = cut(placed.mapInArrow(_regions(length, first), MID_DDL), "regions")
    runs = mid.where(f"kind = {REGION}").select("run", "_id", "_th", "lo", "body")
    twice = cut(runs.groupBy("run").agg(F.count("*").alias("c")).where("c > 1").select("run"), "runs")
    windows = runs.join(twice, "run", "left_semi").mapInArrow(_windows(length), WINDOWS_DDL)
    late = (windows.repartition("h").sortWithinPartitions("h", "h2", "_id", "s")
            .mapInArrow(_late, "_id long, _th long, s long"))
    spans = late.groupBy("_id", "_th").agg(F.collect_list("s").alias("_found"))
    waiting = mid.where(f"kind = {WAITING}").select("_id", "_th", "text", "starts", "ends")
    finished = waiting.join(spans, ["_id", "_th"], "left").mapInArrow(
        _finish(length), "_id long, _th long, n long, removed long, sha string")
    return mid.where(f"kind = {RESULT}").select("_id", "_th", "n", "removed", "sha").unionByName(finished)


def op7_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word windows cut out of every document."""
    return removed_words(documents(spark, sf_dir)).select(
        real_id("_id").alias("doc_id"), F.col("n").alias("n_words"), F.col("removed").alias("n_removed"),
        F.col("sha").alias("kept_sha256"))
