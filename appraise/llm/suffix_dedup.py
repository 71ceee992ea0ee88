"""Substring deduplication by a sparse, distributed suffix array over bytes.

The suffixes are those that start at seeds shared by different regions (see
``passages``); order is by the seed's hash, then by bytes, so key ranges are
even without sampling. Every task sorts its suffixes and front-codes them: the
length of the prefix shared with the one before, then the rest. Runs are
exchanged by key range and merged with a loser tree whose nodes remember the
prefix their loser shares with the winner: of two candidates the one sharing
more with the last output is smaller, and bytes are compared only on equal
lengths, from there on.

The merge yields the order and the common prefixes; a window of 200 bytes that
lies ``o`` bytes before its seed repeats if another entry has the same group by
``200 - o`` bytes of suffix and by ``o`` bytes of left context.

Regions equal in 128 hash bits are settled where they meet and only the others reach
the suffix runs and loser trees (``passages``). All suffixes of one 40-byte seed lie in one key
range.

Null and empty texts have nothing removed; null ids are ids like others. Long texts
are cut into segments of windows. Repeated rows (same id, same text) count as
occurrences of each other and are searched once. Empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm import passages as P
from appraise.llm.common import batch_of, binary_rows, cut, documents, keyed, real_id, shuffle_width

LENGTH = 200
GRAM = 40
FLUSH_BYTES = 32 << 20      # suffix bytes of one sorted run


def byte_symbols(text: bytes) -> np.ndarray:
    return P.BYTE_HASH[np.frombuffer(text, np.uint8)]


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, ``at`` bytes of it known."""
    n = min(len(a), len(b))
    x, y = a[at:n], b[at:n]
    if x == y:
        return n
    d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - 1 - (d.bit_length() - 1) // 8


def front_code(keys: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted keys as shared prefix lengths and remaining bytes."""
    shared, rest, last = [], [], b""
    for k in keys:
        n = common_prefix(last, k, 0)
        shared.append(n)
        rest.append(k[n:])
        last = k
    return shared, rest


def front_decode(shared: list[int], rest: list[bytes]) -> Iterator[tuple[int, bytes]]:
    last = b""
    for n, r in zip(shared, rest):
        last = last[:n] + r
        yield n, last


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, int, bytes]]:
    """Merge front-coded runs: (run, index, prefix shared with the output before, key).

    A loser tree in an array; node 1 is the root, leaf i is node ``size + i``.
    ``lcp[r]`` is what run r's head shares with the last winner it met.
    """
    size = 1
    while size < len(runs):
        size *= 2
    streams = [front_decode(*r) for r in runs]
    heads: list[bytes | None] = [None] * size
    lcp, index = [-1] * size, [-1] * size

    def advance(r: int) -> None:
        nxt = next(streams[r], None)
        index[r] += 1
        lcp[r], heads[r] = nxt if nxt is not None else (-1, None)

    def beats(a: int, b: int) -> bool:
        """Whether head a goes before head b; the loser's shared length is updated."""
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return la > lb
        if la < 0:
            return True
        x, y = heads[a], heads[b]
        n = common_prefix(x, y, la)
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        lcp[b if first else a] = n
        return first

    for r in range(len(runs)):
        advance(r)
        if heads[r] is not None:
            lcp[r] = 0
    losers, winners = [0] * size, list(range(size)) * 2
    for node in range(size - 1, 0, -1):
        a, b = (winners[2 * node], winners[2 * node + 1]) if 2 * node < size else (
            2 * node - size, 2 * node + 1 - size)
        w = a if beats(a, b) else b
        winners[node], losers[node] = w, b if w == a else a
    winner = winners[1] if size > 1 else 0
    while heads[winner] is not None:
        yield winner, index[winner], lcp[winner], heads[winner]
        advance(winner)
        node = (size + winner) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def repeated_offsets(keys_lcp: np.ndarray, lefts: list[bytes], most: np.ndarray, least: np.ndarray,
                     length: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, offset) pairs of windows that another entry has too; entries in suffix order.

    ``keys_lcp``: bytes of suffix (without its hash) shared with the entry before.
    """
    n = len(lefts)
    flipped = [x[::-1] for x in lefts]
    by_left = np.array(sorted(range(n), key=flipped.__getitem__), np.int64)
    left_lcp = np.zeros(n, np.int64)
    for i in range(1, n):
        left_lcp[i] = common_prefix(flipped[by_left[i - 1]], flipped[by_left[i]], 0)
    entry, offset = [], []
    left_group = np.empty(n, np.int64)
    for o in range(int(least.min()), int(most.max()) + 1):
        use = np.flatnonzero((least <= o) & (o <= most))
        if len(use) < 2:
            continue
        right_group = np.cumsum(keys_lcp < length - o)
        left_group[by_left] = np.cumsum(left_lcp < o)
        _, group, count = np.unique(right_group[use] * np.int64(n + 1) + left_group[use],
                                    return_inverse=True, return_counts=True)
        hit = use[count[group] > 1]
        entry.append(hit)
        offset.append(np.full(len(hit), o))
    if not entry:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(entry), np.concatenate(offset)


RESULT, WAITING, RUN = 0, 1, 2
MID = pa.schema([
    ("kind", pa.int32()), ("_id", pa.int64()), ("_th", pa.int64()), ("text", pa.binary()),
    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("n", pa.int64()), ("removed", pa.int64()), ("spans", pa.int64()), ("sha", pa.string()),
    ("part", pa.int32()), ("shared", pa.list_(pa.int32())), ("rest", pa.list_(pa.binary())),
    ("left", pa.list_(pa.binary())), ("ids", pa.list_(pa.int64())), ("ths", pa.list_(pa.int64())),
    ("los", pa.list_(pa.int64())), ("infos", pa.list_(pa.int32()))])
MID_DDL = ("kind int, _id long, _th long, text binary, starts array<long>, ends array<long>, n long, "
           "removed long, spans long, sha string, part int, shared array<int>, rest array<binary>, "
           "left array<binary>, ids array<long>, ths array<long>, los array<long>, infos array<int>")


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return batch_of(schema, [[r.get(n) for r in rows] for n in schema.names])


def cut_out(text: bytes, starts, ends) -> tuple[int, int, str]:
    """(bytes removed, spans, hex digest of what is left)."""
    digest, at, gone = hashlib.sha256(), 0, 0
    for s, e in zip(starts, ends):
        digest.update(text[at:s])
        gone, at = gone + int(e - s), e
    digest.update(text[at:])
    return gone, len(starts), digest.hexdigest()


def _runs_of(entries: list[tuple], parts: int) -> Iterator[dict]:
    """Sorted front-coded runs of (key, left, id, th, lo, info), one per key range."""
    entries.sort(key=lambda e: e[0])
    at = 0
    while at < len(entries):
        part = int.from_bytes(entries[at][0][:4], "big") * parts >> 32
        end = at
        while end < len(entries) and int.from_bytes(entries[end][0][:4], "big") * parts >> 32 == part:
            end += 1
        some = entries[at:end]
        shared, rest = front_code([e[0] for e in some])
        yield {"kind": RUN, "part": part, "shared": shared, "rest": rest, "left": [e[1] for e in some],
               "ids": [e[2] for e in some], "ths": [e[3] for e in some], "los": [e[4] for e in some],
               "infos": [e[5] for e in some]}
        at = end


def _suffixes(length: int, gram: int, parts: int):
    """Per document: the result if all is settled, else the text and its suffixes."""
    def run(batches):
        entries, held = [], 0
        for b in batches:
            rows = []
            for doc, th, found, text in zip(b.column("_id").to_pylist(), b.column("_th").to_pylist(),
                                            b.column("_places").to_pylist(), binary_rows(b.column("_z"))):
                found, zipped, text = P.read_places(found), text, P.unzip(text)
                starts, ends = P.settled_spans(found, length)
                asked = False
                for status, lo, most, least in zip(*(x.tolist() for x in found)):
                    if status == P.DONE:
                        continue
                    at = lo + most
                    key = hashlib.blake2b(text[at:at + gram], digest_size=8).digest() + text[at:at - least + length]
                    entries.append((key, text[lo:at], doc, th, lo, least << 8 | most))
                    held += len(key) + most
                    asked |= status == P.ASK
                row = {"kind": WAITING if asked else RESULT, "_id": doc, "_th": th, "n": len(text)}
                if asked:
                    row |= {"text": zipped, "starts": starts.tolist(), "ends": ends.tolist()}
                else:
                    row |= dict(zip(("removed", "spans", "sha"), cut_out(text, starts.tolist(), ends.tolist())))
                rows.append(row)
            yield _rows(MID, rows)
            if held >= FLUSH_BYTES:
                yield _rows(MID, list(_runs_of(entries, parts)))
                entries, held = [], 0
        if entries:
            yield _rows(MID, list(_runs_of(entries, parts)))
    return run


SPANS = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def compare_part(runs: list[dict], length: int) -> list[np.ndarray] | None:
    """Merge the runs of one key range; spans (id, th, start, end) of its repeated windows."""
    shared, lefts, cols = [], [], []
    for r, i, n, _ in merge_runs([(x["shared"], x["rest"]) for x in runs]):
        x = runs[r]
        shared.append(max(0, n - 8))
        lefts.append(x["left"][i])
        cols.append((x["ids"][i], x["ths"][i], x["los"][i], x["infos"][i]))
    if len(lefts) < 2:
        return None
    doc, th, lo, info = (np.array(c, np.int64) for c in zip(*cols))
    most, least = info & 255, info >> 8
    entry, offset = repeated_offsets(np.array(shared, np.int64), lefts, most, least, length)
    start = lo[entry] + most[entry] - offset
    # Neighbouring windows of one document become one span.
    order = np.lexsort((start, th[entry], doc[entry]))
    d, t, s = doc[entry][order], th[entry][order], start[order]
    if not len(s):
        return None
    new = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > s[:-1] + 1)))
    return [d[new], t[new], s[new], s[np.concatenate((new[1:], [True]))] + length]


def _merge(length: int):
    def run(batches):
        part, runs = None, []
        names = ("shared", "rest", "left", "ids", "ths", "los", "infos")

        def out():
            spans = compare_part(runs, length)
            return [] if spans is None else [batch_of(SPANS, spans)]

        for b in batches:
            for i, p in enumerate(b.column("part").to_pylist()):
                if p != part:
                    yield from out()
                    part, runs = p, []
                runs.append({n: b.column(n)[i].as_py() for n in names})
        yield from out()
    return run


def _finish(batches):
    schema = pa.schema([(n, MID.field(n).type) for n in ("_id", "_th", "n", "removed", "spans", "sha")])
    for b in batches:
        rows = []
        for doc, th, starts, ends, found, text in zip(
                *(b.column(c).to_pylist() for c in ("_id", "_th", "starts", "ends", "_found")),
                binary_rows(b.column("text"))):
            found, text = found or [], P.unzip(text)
            s, e = P.merged(np.array(starts + [x["s"] for x in found], np.int64),
                            np.array(ends + [x["e"] for x in found], np.int64))
            rows.append((doc, th, len(text), *cut_out(text, s.tolist(), e.tolist())))
        yield batch_of(schema, [list(c) for c in zip(*rows)] if rows else [[]] * 6)


def removed_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: _id, _th, n, removed, spans, sha (of the bytes left).

    Bytes covered by a ``length``-byte string that also starts anywhere else go. Of rows
    that agree in id and text one goes through the search; all of its windows
    start in the others too, so its copies need no search of their own.
    """
    whole = keyed(docs, id_col, text_col)
    many = cut(whole.groupBy("_id", "_th").agg(F.count("*").alias("_times")).where("_times > 1"), "repeated")
    if not many.head(1):
        return _removed(whole, length, gram)
    single = whole.join(many, ["_id", "_th"], "left_anti")
    one = whole.join(many, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
    found = _removed(cut(single.unionByName(one), "distinct-rows"), length, gram).join(many, ["_id", "_th"], "left")
    gone = F.col("_times").isNotNull() & (F.col("n") >= length)
    return found.select(
        "_id", "_th", "n", F.when(gone, F.col("n")).otherwise(F.col("removed")).alias("removed"),
        F.when(gone, 1).otherwise(F.col("spans")).cast("long").alias("spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("sha"),
        F.explode(F.sequence(F.lit(1), F.coalesce(F.col("_times"), F.lit(1)))).alias("_nth")).drop("_nth")


def _removed(whole: DataFrame, length: int, gram: int) -> DataFrame:
    parts = shuffle_width(whole.sparkSession)
    placed = P.with_places(whole, byte_symbols, gram, length, earliest=False)
    mid = cut(placed.mapInArrow(_suffixes(length, gram, parts), MID_DDL), "suffixes")
    spans = (mid.where(f"kind = {RUN}").select("part", "shared", "rest", "left", "ids", "ths", "los", "infos")
             .repartition(parts, "part").sortWithinPartitions("part")
             .mapInArrow(_merge(length), "_id long, _th long, s long, e long"))
    spans = spans.groupBy("_id", "_th").agg(F.collect_list(F.struct("s", "e")).alias("_found"))
    waiting = mid.where(f"kind = {WAITING}").select("_id", "_th", "text", "starts", "ends")
    finished = waiting.join(spans, ["_id", "_th"], "left").mapInArrow(
        _finish, "_id long, _th long, n long, removed long, spans long, sha string")
    return mid.where(f"kind = {RESULT}").select("_id", "_th", "n", "removed", "spans", "sha").unionByName(finished)


def op3_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings cut out of every document."""
    return removed_bytes(documents(spark, sf_dir)).select(
        real_id("_id").alias("doc_id"), F.col("n").alias("n_bytes"), F.col("removed").alias("n_removed"),
        F.col("spans").alias("n_spans"), F.col("sha").alias("kept_sha256"))
