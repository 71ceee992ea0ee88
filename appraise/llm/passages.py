"""Repeated fixed-length windows: seeds, regions and their exchange.

Shared by the byte and the word form of substring deduplication. A document is
a row of symbols (bytes or words). Every window of ``length`` symbols owns one
seed: its smallest hashed gram of ``gram`` symbols (leftmost on ties), so equal
windows own equal seeds at equal offsets. Consecutive windows with one seed form
a region, about one for every ``(length - gram) / 2`` symbols. Only seeds that
occur twice can belong to repeated windows, and windows can only equal windows
whose seed is equal: that is what bounds everything after the first exchange.

The exchange carries (seed hash, region hash, document, place), no text. Every
task folds equal regions of its own documents first, so a passage that a third
of all documents share leaves one row per task. Regions equal in all 128 hash
bits are settled there; only where one seed has different regions is one
representative of each looked at symbol by symbol.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from appraise.llm.common import batch_of, binary_rows

SEGMENT = 1 << 16           # windows handled at a time in long documents
FLUSH_AT = 1 << 20          # regions a task folds at a time
DONE, ASK, PARTNER = 0, 1, 2    # windows settled / to be compared / settled but needed as a partner
_LOW = np.uint64((1 << 20) - 1)
_rng = np.random.default_rng(7)
BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE2 = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(BASE2), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_PW, _IPW = powers(BASE2, SEGMENT + 4096), powers(_INVERSE, SEGMENT + 4096)


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` symbols, built by doubling run lengths."""
    out, size, cur, width, power = None, 0, symbols, 1, int(BASE)
    while True:
        if k & 1:
            if out is None:
                out = cur
            else:
                n = len(symbols) - size - width + 1
                out = out[:n] * np.uint64(power) + cur[size:size + n]
            size += width
        k >>= 1
        if not k:
            return mixed(out)
        n = len(symbols) - 2 * width + 1
        cur = cur[:n] * np.uint64(power) + cur[width:width + n]
        width, power = 2 * width, power * power % (1 << 64)


def regions(symbols: np.ndarray, gram: int, length: int):
    """(seed hash, region hash, first window, most offset, least offset) arrays of a document.

    Offsets count from a window's start to its seed: the region's windows start
    at ``first`` .. ``first + most - least``.
    """
    parts = []
    w = length - gram + 1
    for base in range(0, max(0, len(symbols) - length + 1), SEGMENT):
        s = symbols[base:base + SEGMENT + length - 1]
        h = gram_hashes(s, gram)
        v = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        m = len(h) - w + 1
        x = np.concatenate((v, np.full(-len(h) % w, ~np.uint64(0)))).reshape(-1, w)
        ahead = np.minimum.accumulate(x, axis=1).ravel()
        behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
        owner = (np.minimum(behind[:m], ahead[w - 1:w - 1 + m]) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        last = np.concatenate((first[1:], [m])) - 1
        seed = owner[first]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(s * _PW[:len(s)], dtype=np.uint64)))
        body = (sums[last + length] - sums[first]) * _IPW[first]
        whole = mixed(body + mixed(((seed - first) * 65536 + (last - first)).astype(np.uint64) + np.uint64(1)))
        parts.append((h[seed], whole, first + base, seed - first, seed - last))
    if not parts:
        return None
    return [np.concatenate(c) for c in zip(*parts)]


# A region's place in one long: first window, two flag or status bits, least and most offset.
# The text's whole hash goes with the id: rows that share an id but not a text are other documents.
SEEDS = pa.schema([("g", pa.int64()), ("rh", pa.int64()), ("_id", pa.int64()), ("_th", pa.int64()), ("p", pa.int64())])
SEEDS_DDL = "g long, rh long, _id long, _th long, p long"
PLACES = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("p", pa.int64())])
PLACES_DDL = "_id long, _th long, p long"
SETTLED, TWICE = 1 << 16, 1 << 17
_FLAGS = 3 << 16


def place_of(lo, most, least):
    return lo << 32 | least << 8 | most


def read_places(found: list[int] | None):
    """(status, first window, most, least offset) arrays of a document's places."""
    p = np.array(found or [], np.int64)
    return (p >> 16) & 3, p >> 32, p & 255, (p >> 8) & 255


def _fold(rows: list[np.ndarray], earliest: bool):
    """Fold equal regions of one task.

    The first (by id, place, text) stays, the others are settled. With ``earliest``
    the first itself stays open and a repeated row is no copy of itself.
    """
    g, rh, doc, th, p = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((th, p, doc, rh, g))
    g, rh, doc, th, p = (c[order] for c in (g, rh, doc, th, p))
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (rh[1:] != rh[:-1])))
    run = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate((start, [len(g)])))
    first = start[run]
    copy = ~new
    keep = np.ones(len(g), bool)
    if earliest:
        same = copy & (doc == doc[first]) & (p >> 32 == p[first] >> 32)
        keep = ~(same & (p == p[first]) & (th == th[first]))
        copy &= ~same
    else:
        p = np.where(new & (size[run] > 1), p | TWICE, p)
    p = np.where(copy, p | SETTLED, p)
    # Settled rows only travel to their document: spread them.
    g = np.where(copy, mixed((rh ^ p * 3 ^ doc * 5 ^ th * 7).view(np.uint64)).view(np.int64), g)
    order = np.lexsort((p, th, doc))            # neighbours alike: the shuffle files compress better
    order = order[keep[order]]
    return [c[order] for c in (g, rh, doc, th, p)]


def seed_rows(docs: DataFrame, symbolise, gram: int, length: int, earliest: bool) -> DataFrame:
    """Regions of (_id, _th, _text) rows, folded within each task."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            ids, ths = b.column("_id").to_pylist(), b.column("_th").to_pylist()
            for doc, th, text in zip(ids, ths, binary_rows(b.column("_text"))):
                found = regions(symbolise(text), gram, length) if len(text) >= length else None
                if found is None:
                    continue
                g, rh, lo, most, least = found
                held.append((g.view(np.int64), rh.view(np.int64), np.full(len(g), doc), np.full(len(g), th),
                             place_of(lo, most, least)))
                n += len(g)
            if n >= FLUSH_AT:
                yield batch_of(SEEDS, _fold(held, earliest))
                held, n = [], 0
        if held:
            yield batch_of(SEEDS, _fold(held, earliest))
    return docs.mapInArrow(run, SEEDS_DDL)


def _classify(batches, earliest: bool):
    """Rows sorted by (g, rh, _id, p, _th): what is settled and what must be compared.

    Streams; held back is one run of equal regions, at most a row per task.
    """
    carry, before = None, None

    def decide(c, following):
        nonlocal before
        g, rh, doc, th, p = c
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (rh[1:] != rh[:-1])))
        start = np.flatnonzero(new)
        end = np.concatenate((start[1:], [len(g)]))
        run = np.cumsum(new) - 1
        prev_g = np.concatenate(([before if before is not None else ~g[0]], g[:-1]))
        next_g = np.concatenate((g[1:], [following if following is not None else ~g[-1]]))
        mixed_class = (prev_g[start] == g[start]) | (next_g[end - 1] == g[end - 1])
        before = g[-1]
        many = (end - start > 1) | ((p[start] & TWICE) != 0)
        first = start[run]
        status = np.full(len(g), -1)
        if earliest:
            tie = (doc == doc[first]) & (p >> 32 == p[first] >> 32)
            status[~tie] = DONE
            status[tie & mixed_class[run]] = ASK
        else:
            status[many[run]] = DONE
            status[new & many[run] & mixed_class[run]] = PARTNER
            status[new & ~many[run] & mixed_class[run]] = ASK
        status[(p & SETTLED) != 0] = DONE
        keep = status >= 0
        return batch_of(PLACES, [doc[keep], th[keep], (p[keep] & ~_FLAGS) | status[keep] << 16])

    for b in batches:
        c = [b.column(n).to_numpy() for n in SEEDS.names]
        if carry is not None:
            c = [np.concatenate(x) for x in zip(carry, c)]
        if not len(c[0]):
            continue
        g, rh = c[0], c[1]
        same = (g == g[-1]) & (rh == rh[-1])
        cut_at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut_at:
            yield decide([x[:cut_at] for x in c], g[cut_at])
        carry = [x[cut_at:].copy() for x in c]
    if carry is not None:
        yield decide(carry, None)


def with_places(docs: DataFrame, symbolise, gram: int, length: int, earliest: bool) -> DataFrame:
    """(_id, _th, _z, _places): every document, its text zipped, with the regions that are settled
    or must be compared."""
    rows = seed_rows(docs, symbolise, gram, length, earliest)
    judged = rows.repartition("g").sortWithinPartitions("g", "rh", "_id", "p", "_th").mapInArrow(
        lambda it: _classify(it, earliest), PLACES_DDL)
    places = judged.groupBy("_id", "_th").agg(F.collect_list("p").alias("_places"))
    return zipped(docs).join(places, ["_id", "_th"], "left")


ZIPPED = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("_z", pa.binary())])


def zipped(docs: DataFrame) -> DataFrame:
    """Texts compressed one by one: they cross the shuffles and the scratch folder in that form."""
    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield batch_of(ZIPPED, [b.column("_id"), b.column("_th"), [pack(t) for t in binary_rows(b.column("_text"))]])
    return docs.mapInArrow(run, "_id long, _th long, _z binary")


def unzip(z: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(z)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open intervals (touching ones join)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return s[new], e[np.concatenate((new[1:], [True]))]


def settled_spans(found, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the settled regions among a document's places."""
    status, lo, most, least = found
    use = status != ASK
    return merged(lo[use], (lo + most - least + length)[use])
