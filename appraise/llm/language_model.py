"""Document log-likelihood under a gated recurrent word model.

Counts: every training document's words are counted (folded per task, then by
word). The most frequent words, a bounded head of at most ``HEAD``, are shared with
the tasks; all other words stay in a table and are joined.

Model: a GRU over words with a class-factored softmax. The words of the head
form classes of equal sums of the square roots of their counts, so frequent words sit in
small classes; each class has a softmax of its own, each word an input row. All other words,
unseen ones included, form a band whose inside is the smoothed unigram of the
counts. Biases start at the corpus frequencies.

Training: truncated backpropagation in numpy on every training document, once. The
documents are dealt to shards by a hash of id and text, about ``SHARD_TOKENS``
tokens each, and lie there in the order of that hash: the number of shards and what each
one learns, and so the model, depend on the data alone, not on the cluster's cores or the
files' layout. A shard is one task's stream of bounded chunks. After a first
quarter of each shard (by hash) and again at the end the shards' weights are averaged, each
weight over the shards that moved it, in the order of the shards. A lost executor repeats its
shard. Rows equal in id and text lie in one shard.

Scoring carries the state across windows, so a score is the whole document's. Training and
scoring read one table of the documents' ids.

Null and empty texts are one end token. Null ids count as the empty string for
the split. Very long texts are one stream of windows. Repeated rows are counted and
scored as often as they are listed; words of equal count rank by their bytes. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm.common import batch_of, binary_rows, cut, documents, id_of, one_thread, real_id, text_of

HEAD = 1 << 16             # most words, the end token among them, with rows of their own
CLASSES = 128               # softmax classes of the head; one more is the band of all other words
HIDDEN = 16
LANES, STEPS = 512, 32      # training: most parallel streams, and tokens between truncations
LEAST_UPDATES = 128          # a chunk is dealt to so few lanes that it gives this many updates
CHUNK = 1 << 21             # tokens a task deals to its lanes at a time
SHARD_TOKENS = 1 << 23
ROUNDS = (0.25, 0.75)       # shares of each shard between averages
RATE = 0.1
SCORE_LANES, SCORE_STEPS = 512, 64
BLOCK = 1 << 15             # states whose classes are gathered at a time
NEAR = 1 << 10              # states whose class softmax is taken at a time, near the core
ROOM = np.empty(1 << 17, np.float32)    # where softmaxes are taken: one place, that stays near the core
ONES = np.ones(HEAD + 1, np.float32)
LARGE = 1e26                # sums of exponentials beyond it, or below its inverse, are taken again from shifted rows
PIECE = 8192                # weights averaged in one group
END = 0                     # the end token's place in the vocabulary


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 5 == 1


# --- counts ---------------------------------------------------------------

COUNTS = pa.schema([("word", pa.binary()), ("c", pa.int64())])
FLUSH_WORDS = 1 << 20


def _count(batches):
    seen: Counter = Counter()

    def out():
        items = list(seen.items())
        for at in range(0, len(items), 1 << 16):
            yield batch_of(COUNTS, [list(c) for c in zip(*items[at:at + (1 << 16)])])

    for b in batches:
        for text in binary_rows(b.column("_text")):
            seen.update(text.lower().split())
        if len(seen) >= FLUSH_WORDS:
            yield from out()
            seen = Counter()
    yield from out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over a ``_text`` column."""
    return texts.select("_text").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_of(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words above a count threshold chosen so that at most ``most`` remain, by rank."""
    level = F.floor(F.log2(F.col("c")) * 8).cast("int")
    sizes = counts.groupBy(level.alias("l")).agg(F.count("*").alias("n")).orderBy(F.desc("l")).collect()
    total, least = 0, None
    for r in sizes:                            # at most 8 levels per power of two
        total += r["n"]
        if total > most:
            break
        least = r["l"]
    if least is None:
        return []
    rows = counts.where(level >= least).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """Ranked head words with their counts; place 0 is the end token, class ``CLASSES`` the band."""

    def __init__(self, head: list[tuple[bytes, int]], ends: int, total: int, distinct: int):
        self.words = [w for w, _ in head]
        self.counts = np.array([ends, *(c for _, c in head)], np.float64)
        self.total, self.distinct = total, distinct
        n = len(self.counts)
        rest_n, rest_v = total - self.counts.sum(), max(0, distinct - n)
        self.rest_scale = math.log10(rest_n + 0.5 * (rest_v + 1))
        root = np.cumsum(np.sqrt(self.counts + 1))
        of = np.minimum((root - root[0]) * CLASSES // (root[-1] * (1 + 1e-9)), CLASSES - 1).astype(np.int64)
        self.edges = np.searchsorted(of, np.arange(CLASSES + 1))       # class k: words edges[k] to edges[k + 1]
        self.classes = np.append(of, CLASSES)
        size = np.bincount(of, self.counts, CLASSES)
        self.class_bias = np.log(np.append(size, rest_n) + 0.5)
        self.class_bias[:CLASSES][np.diff(self.edges) == 0] = -1e4
        top = np.maximum.reduceat(self.counts, np.unique(self.edges[:-1][np.diff(self.edges) > 0]))
        self.member_bias = np.log(self.counts + 0.5) - np.log(np.repeat(top, np.diff(self.edges)[np.diff(self.edges) > 0]) + 0.5)

    def index(self) -> dict[bytes, int]:
        return {w: i + 1 for i, w in enumerate(self.words)}

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        """Class per id; the id behind the head's is the band."""
        return self.classes[ids]


def encode(words: list[bytes], index: dict[bytes, int], rest: int) -> np.ndarray:
    ids = np.fromiter(map(index.get, words, repeat(rest)), np.int64, len(words))
    return np.append(ids, END)


# --- the network ----------------------------------------------------------

def new_weights(v: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    h, n = HIDDEN, len(v.counts)
    return {k: a.astype(np.float32) for k, a in {
        "x": r.normal(0, 0.1, (n + 1, 3 * h)), "u": r.normal(0, 0.15, (h, 3 * h)),
        "c": np.vstack([r.normal(0, 0.02, (h, CLASSES + 1)), v.class_bias - v.class_bias.max()]),
        "m": np.column_stack([r.normal(0, 0.02, (n, h)), v.member_bias])}.items()}


def _one(states: np.ndarray) -> np.ndarray:
    """States with a one behind them: the last row of ``c`` and column of ``m`` are biases."""
    return np.column_stack([states, np.ones(len(states), states.dtype)])


def step(w: dict, x: np.ndarray, h: np.ndarray):
    """One GRU step for input rows ``x``: the new state and what going back needs."""
    n = HIDDEN
    a, g = w["x"].take(x, axis=0), h @ w["u"]
    s = a[:, :2 * n] + g[:, :2 * n]
    z, r = s[:, :n], s[:, n:]
    with np.errstate(over="ignore"):            # exponentials cost less than tanh; an infinite one gives 0, or tanh 1
        np.exp(np.negative(s, out=s), out=s)
        s += 1
        np.divide(1, s, out=s)
        c = r * g[:, 2 * n:]
        c += a[:, 2 * n:]
        c *= 2
        np.exp(c, out=c)
        c += 1
        np.divide(-2, c, out=c)
        c += 1                                  # tanh is 1 - 2 / (1 + exp(2 x))
    new = h - c
    new *= z
    new += c
    return new, (z, r, c, g[:, 2 * n:], h)


def _exp(states: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of ``states @ w`` and their sums by row; rows are shifted only where they could overflow.

    The exponentials lie in ``ROOM`` until the next call, if they fit there."""
    size = len(states) * w.shape[1]
    x = np.matmul(states, w, out=ROOM[:size].reshape(len(states), -1) if size <= len(ROOM) else None)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    total = x @ ONES[:x.shape[1]]               # one product, not a reduction of short rows
    if np.maximum.reduce(total) > LARGE or np.minimum.reduce(total) < 1 / LARGE:
        x = states @ w
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        total = x.sum(axis=1)
    return x, total


def by_class(classes: np.ndarray):
    """The rows in the order of their classes, and (class, its rows there) of the softmax classes present."""
    order = np.argsort(classes.astype(np.int16), kind="stable")
    edges = np.searchsorted(classes[order], np.arange(CLASSES + 1)).tolist()
    return order, [(k, slice(*e)) for k, e in enumerate(zip(edges, edges[1:])) if e[0] < e[1]]


def _goals(at: np.ndarray, width: int) -> np.ndarray:
    """Places of one column per row in the flat matrix."""
    return np.arange(0, len(at) * width, width) + at


def _log_share(states: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of ``states @ w`` at one column per row."""
    width, out = w.shape[1], np.empty(len(at), np.float32)
    rows = max(1, len(ROOM) // width)
    for s in range(0, len(at), rows):
        mine = slice(s, s + rows)
        x, total = _exp(states[mine], w)
        np.divide(x.ravel().take(_goals(at[mine], width)), total, out=out[mine])
    out += np.float32(1e-38)
    return np.log(out, out=out)


def _pull(states: np.ndarray, w: np.ndarray, at: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a softmax with the goals ``at`` asks: exponentials less their sum at the goal, the states that
    turn them into the gradient of ``w``, which both bear the division by the sum; ``out`` gets the states' gradient."""
    x, total = _exp(states, w)
    x.ravel()[_goals(at, w.shape[1])] -= total
    part = (1 / total)[:, None]
    np.matmul(x, w[:HIDDEN].T, out=out)
    out *= part
    return x, states * part


def log10_probs(w: dict, v: Vocabulary, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Model log10 probability of each id after its state; rest words up to their inside share."""
    classes, states = v.class_of(ids), _one(states)
    out = np.empty(len(ids))
    for s in range(0, len(ids), NEAR):
        out[s:s + NEAR] = _log_share(states[s:s + NEAR], w["c"], classes[s:s + NEAR])
    order, present = by_class(classes)
    states, ids, inside = states.take(order, axis=0), ids[order], np.zeros(len(ids))
    for k, rows in present:
        first, last = v.edges[k], v.edges[k + 1]
        if last - first > 1:                    # the only word of a class is certain in it
            inside[rows] = _log_share(states[rows], w["m"][first:last].T, ids[rows] - first)
    out[order] += inside
    return out / math.log(10)


def adagrad(w: np.ndarray, seen: np.ndarray, g: np.ndarray, scale: float) -> None:
    """One update in place, in pieces near the core; where ``g`` is zero nothing moves."""
    w, seen, g = w.reshape(-1), seen.reshape(-1), g.reshape(-1)        # views of whole arrays
    room = np.empty(min(len(g), NEAR * HIDDEN), np.float32)
    for at in range(0, len(g), NEAR * HIDDEN):
        a, s = g[at:at + NEAR * HIDDEN], seen[at:at + NEAR * HIDDEN]
        root = room[:len(a)]
        a *= np.float32(scale)
        np.multiply(a, a, out=root)
        s += root
        np.add(s, np.float32(1e-8), out=root)
        np.sqrt(root, out=root)
        a *= np.float32(RATE)
        a /= root
        w[at:at + NEAR * HIDDEN] -= a


def train_stream(w: dict, v: Vocabulary, ids: np.ndarray, seen: dict | None = None) -> tuple[dict, int]:
    """Truncated backpropagation over a token stream, dealt to parallel lanes.

    Every token but the first is a goal once. With ``seen``, the squared
    gradients so far, ``w`` and ``seen`` are brought forward in place.
    """
    if seen is None:
        w = {k: a.copy() for k, a in w.items()}
        seen = {k: np.full_like(a, START) for k, a in w.items()}
    lanes = max(1, min(LANES, len(ids) // (LEAST_UPDATES * STEPS)))
    length = (len(ids) - 1) // lanes
    if length < 1:
        return w, 0
    flow = ids[np.arange(length + 1)[:, None] + np.arange(lanes) * length]      # a lane begins with the last goal before it
    h, edges = np.zeros((lanes, HIDDEN), np.float32), v.edges.tolist()
    for at in range(0, length, STEPS):
        t = min(STEPS, length - at)
        xs = flow[at:at + t]
        kept, states = [], np.empty((t, lanes, HIDDEN), np.float32)
        for i in range(t):
            h, k = step(w, xs[i], h)
            states[i] = h
            kept.append(k)
        flat, goal = states.reshape(-1, HIDDEN), flow[at + 1:at + 1 + t].ravel()
        classes, one = v.class_of(goal), _one(flat)
        g = {k: np.zeros_like(w[k]) for k in "cm"}
        dflat = np.empty_like(flat)
        for s in range(0, len(goal), NEAR):
            e, mine = _pull(one[s:s + NEAR], w["c"], classes[s:s + NEAR], dflat[s:s + NEAR])
            g["c"] += (e.T @ mine).T
        order, present = by_class(classes)
        one, inside, parts = one.take(order, axis=0), np.zeros_like(flat), []
        member = goal[order] - v.edges[classes[order]]
        for k, rows in present:
            part = slice(edges[k], edges[k + 1])
            if part.stop - part.start < 2:
                continue
            e, mine = _pull(one[rows], w["m"][part].T, member[rows], inside[rows])
            parts.append(np.matmul(e.T, mine, out=g["m"][part]))
        turned = np.empty_like(order)
        turned[order] = np.arange(len(order))
        dflat += inside.take(turned, axis=0)
        dstates, dh = dflat.reshape(t, lanes, HIDDEN), np.zeros((lanes, HIDDEN), np.float32)
        das, dgs = np.empty((2, t, lanes, 3 * HIDDEN), np.float32)
        back = w["u"].T.copy()
        for i in range(t - 1, -1, -1):
            z, r, c, gn, last = kept[i]
            dh = dh + dstates[i]
            dc = dh * (1 - z)
            dc *= 1 - c * c
            da, dg = das[i], dgs[i]
            da[:, :HIDDEN] = dh * (last - c) * (z * (1 - z))
            da[:, HIDDEN:2 * HIDDEN] = dc * gn * (r * (1 - r))
            da[:, 2 * HIDDEN:] = dc
            dg[:, :2 * HIDDEN] = da[:, :2 * HIDDEN]
            dg[:, 2 * HIDDEN:] = dc * r
            dh = dh * z + dg @ back
        g["u"] = np.concatenate([kept[0][4], flat[:-lanes]]).T @ dgs.reshape(-1, 3 * HIDDEN)
        order = np.argsort(xs.ravel().astype(np.uint16 if len(v.counts) < 1 << 16 else np.int64), kind="stable")
        inputs = xs.ravel()[order]
        first = np.flatnonzero(np.diff(inputs, prepend=-1))
        inputs = inputs[first]
        g["x"] = np.add.reduceat(das.reshape(-1, 3 * HIDDEN).take(order, axis=0), first, axis=0)
        norm = math.sqrt(sum(float(np.vdot(a, a)) for a in (g["c"], *parts, g["u"], g["x"]))) / len(goal)
        scale = min(1.0, 1.0 / (norm + 1e-9)) / len(goal)
        for name, a in g.items():
            if name == "x":
                now, s = w[name].take(inputs, axis=0), seen[name].take(inputs, axis=0)
                adagrad(now, s, a, scale)
                w[name][inputs], seen[name][inputs] = now, s
            else:
                adagrad(w[name], seen[name], a, scale)
    if lanes * length < len(ids) - 1:          # fewer than there are lanes
        train_stream(w, v, ids[lanes * length:], seen)
    return w, len(ids) - 1


def flatten(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unflatten(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = flat[at:at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


PIECES = pa.schema([("piece", pa.int32()), ("shard", pa.int32()), ("values", pa.binary()), ("n", pa.float64())])
PIECES_DDL = "piece int, shard int, values binary, n double"
START = np.float32(1e-6)    # of the squared gradients
ENCODED = pa.schema([("_id", pa.int64()), ("held_out", pa.bool_()), ("h", pa.int64()), ("n_tokens", pa.int64()),
                     ("known", pa.int64()), ("base", pa.float64()), ("ids", pa.binary()), ("rest", pa.list_(pa.binary())),
                     ("times", pa.list_(pa.int64()))])
ENCODED_DDL = ("_id long, held_out boolean, h long, n_tokens long, known long, base double, ids binary, "
               "rest array<binary>, times array<long>")


def id_kind(v: Vocabulary):
    return np.uint16 if len(v.counts) < 1 << 16 else np.uint32


def _encoded(v: Vocabulary):
    """Every document's ids, what the counts say of them, and its words outside the head."""
    def run(batches):
        index, n_head, kind = v.index(), len(v.counts), id_kind(v)
        logs = np.log10(v.counts + 0.5)
        for b in batches:
            ids, sizes, known, base, rest, times = [], [], [], [], [], []
            for text in binary_rows(b.column("_text")):
                words = text.lower().split()
                doc = encode(words, index, n_head)
                in_head = doc[doc < n_head]
                far = Counter([words[i] for i in np.flatnonzero(doc == n_head)])
                ids.append(doc.astype(kind).tobytes())
                sizes.append(len(doc))
                known.append(int((v.counts[in_head] > 0).sum()))
                base.append(float(logs[in_head].sum()))
                rest.append(list(far))
                times.append(list(far.values()))
            yield batch_of(ENCODED, [b.column("_id"), b.column("held_out"), b.column("h"), sizes, known, base, ids, rest, times])
    return run


def dealt(docs: DataFrame, shards: int) -> DataFrame:
    """``ids`` with their shard, round and order there, all from the hash ``h`` as an unsigned number."""
    h, n = F.col("h"), F.lit(shards).cast("long")
    shard = F.pmod(F.pmod(h, n) + F.when(h < 0, F.lit(2 ** 64 % shards)).otherwise(F.lit(0)), n)
    share = F.shiftrightunsigned(h, 40) / F.lit(2.0 ** 24)
    part = sum(((share >= F.lit(float(b))).cast("int") for b in np.cumsum(ROUNDS)[:-1]), F.lit(0))
    return docs.select(shard.cast("int").alias("shard"), part.alias("part"), h.alias("order"), "ids")


def chunks(rows, kind):
    """Token streams of bounded size from documents' ids, each stream after an end token."""
    held, n = [], 0
    for ids in rows:
        held.append(np.frombuffer(ids, kind).astype(np.int64))
        n += len(held[-1])
        if n >= CHUNK:
            yield np.concatenate([[END], *held])
            held, n = [], 0
    if held:
        yield np.concatenate([[END], *held])


def train(docs: DataFrame, v: Vocabulary, shard_tokens: int = SHARD_TOKENS) -> dict[str, np.ndarray]:
    """Rounds of training by shard and averaging; ``docs`` holds ``ids`` and a hash ``h`` of the training documents.

    What the shards send grows with their number, that is with the tokens: a shard's
    moved weights (17 MB at most) for every ``SHARD_TOKENS`` tokens and round.
    """
    w = new_weights(v)
    shards = max(1, math.ceil(v.total / shard_tokens))
    kind, rows_of = id_kind(v), dealt(docs, shards)

    for part in range(len(ROUNDS)):
        def local(batches, w=w):
            one_thread()
            mine, seen, n, shard = None, None, 0, None

            def rows():
                nonlocal shard
                for b in batches:
                    if len(b):
                        shard = b.column("shard")[0].as_py()
                        yield from (i.as_py() for i in b.column("ids"))
            for ids in chunks(rows(), kind):
                if mine is None:
                    mine = {k: a.copy() for k, a in w.items()}
                    seen = {k: np.full_like(a, START) for k, a in w.items()}
                n += train_stream(mine, v, ids, seen)[1]
            if n and all(np.isfinite(a).all() for a in mine.values()):
                flat = flatten(mine)
                flat[flatten(seen) == START] = np.nan       # not moved here
                for i, a in enumerate(range(0, len(flat), PIECE)):
                    values = flat[a:a + PIECE]
                    if not np.isnan(values).all():
                        yield batch_of(PIECES, [[i], [shard], [values.tobytes()], [float(n)]])

        def average(batches):
            """Pieces come by (piece, shard), so the sums are taken in one order."""
            now, x, n = None, None, None

            def done():
                return batch_of(PIECES, [[now], [0], [np.where(n > 0, x / np.maximum(n, 1), np.nan).astype(np.float32).tobytes()], [1.0]])
            for b in batches:
                for piece, values, weight in zip(*(b.column(c).to_pylist() for c in ("piece", "values", "n"))):
                    mine = np.frombuffer(values, np.float32).astype(np.float64)
                    if piece != now:
                        if now is not None:
                            yield done()
                        now, x, n = piece, np.zeros(len(mine)), np.zeros(len(mine))
                    moved = ~np.isnan(mine)
                    x += np.where(moved, mine, 0) * weight
                    n += moved * weight
            if now is not None:
                yield done()

        streams = rows_of.where(F.col("part") == part).repartitionById(shards, F.col("shard")).sortWithinPartitions("order", "ids")
        pieces = streams.mapInArrow(local, PIECES_DDL).repartition("piece").sortWithinPartitions("piece", "shard")
        flat = flatten(w)
        for r in pieces.mapInArrow(average, PIECES_DDL).collect():
            x = np.frombuffer(r["values"], np.float32)
            old = flat[r["piece"] * PIECE:][:len(x)]
            np.copyto(old, x, where=~np.isnan(x))
        w = unflatten(flat, w)
    return w


# --- scoring --------------------------------------------------------------

def lanes_of(sizes: np.ndarray, most: int) -> list[list[int]]:
    """Documents dealt whole to at most ``most`` lanes, the longest first, each to the shortest lane; the longest lane first."""
    lanes = [[] for _ in range(min(most, len(sizes)))]
    heap = [(0, k) for k in range(len(lanes))]
    for i in np.argsort(-sizes, kind="stable").tolist():
        n, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (n + int(sizes[i]), k))
    return [lanes[k] for _, k in sorted(heap, key=lambda x: (-x[0], x[1]))]


def score_ids(w: dict, v: Vocabulary, docs: list[np.ndarray]) -> np.ndarray:
    """Log10 probability per document, the state carried over windows; rest words without their inside.

    A lane goes through its documents one after the other, so nearly all lanes are busy until the end."""
    out = np.zeros(len(docs))
    if not len(docs):
        return out
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    lanes = lanes_of(sizes, SCORE_LANES)
    order = np.concatenate([np.array(x, np.int64) for x in lanes])
    flow = np.concatenate([docs[i] for i in order]).astype(np.int32)        # ids that fit 16 bits come as such
    owner = np.repeat(order.astype(np.int32), sizes[order])
    inputs = np.append(np.int32(END), flow[:-1])
    fresh = np.append(True, owner[1:] != owner[:-1])
    inputs[fresh] = END
    length = np.array([sizes[x].sum() for x in lanes])
    begin = np.cumsum(length) - length
    h = np.zeros((len(lanes), HIDDEN), np.float32)
    for start in range(0, int(length[0]), SCORE_STEPS):
        at = np.arange(start, min(start + SCORE_STEPS, int(length[0])))
        live = np.searchsorted(-length, -at)                # lanes are sorted: the first go on
        places = [begin[:k] + a for k, a in zip(live.tolist(), at.tolist())]
        place = np.concatenate(places)
        xs, new, states, n = inputs[place], fresh[place], np.empty((len(place), HIDDEN), np.float32), 0
        for k in live.tolist():
            h = h[:k]
            h[new[n:n + k]] = 0
            h, _ = step(w, xs[n:n + k], h)
            states[n:n + k] = h
            n += k
        goal = flow[place]
        p = np.concatenate([log10_probs(w, v, states[a:a + BLOCK], goal[a:a + BLOCK]) for a in range(0, len(goal), BLOCK)])
        out += np.bincount(owner[place], p, minlength=len(docs))
    return out


SCORED = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
SCORED_DDL = "_row long, _id long, held_out boolean, n_tokens long, known long, base double, score double"


def _score(w: dict, v: Vocabulary):
    def run(batches):
        one_thread()
        kind = id_kind(v)
        for b in batches:
            score = score_ids(w, v, [np.frombuffer(i, kind) for i in binary_rows(b.column("ids"))])
            yield batch_of(SCORED, [*(b.column(c) for c in SCORED.names[:-1]), score])
    return run


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(id_of(id_col).alias("_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("_text"))
    learn = rows.where("not held_out")
    counts = cut(word_counts(learn), "counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = learn.count()
    v = Vocabulary(head_of(counts, HEAD - 1), ends, sums["n"] + ends, sums["v"] + (ends > 0))
    coded = cut(rows.withColumn("h", F.xxhash64("_id", "_text")).mapInArrow(_encoded(v), ENCODED_DDL)
                .withColumn("_row", F.monotonically_increasing_id()), "tokens")     # read for training and scoring
    w = train(coded.where("not held_out").select("h", "ids"), v)
    part = cut(coded.select(*SCORED.names[:-1], "ids").mapInArrow(_score(w, v), SCORED_DDL), "scores")
    rest = coded.select("_row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select(
        "_row", F.col("x.rest").alias("word"), F.col("x.times").alias("n"))
    logs = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    rest = rest.join(counts, "word", "left").groupBy("_row").agg(
        F.sum(F.col("n") * logs).alias("rest_log"), F.sum("n").alias("rest_n"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rest_known"))
    scale = math.log10(v.total + 0.5 * (v.distinct + 1))
    zero = F.lit(0)
    return part.join(rest, "_row", "left").select(
        real_id("_id").alias("doc_id"), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rest_known", zero)).alias("n_known"),
        F.lit(int(v.total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_log", zero) - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("score") + F.coalesce("rest_log", zero)
         - F.coalesce("rest_n", zero) * F.lit(v.rest_scale)).alias("score"))


def op4_gru_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every whole document."""
    return scores(documents(spark, sf_dir))
