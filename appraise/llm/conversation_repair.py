"""Repairing the turn structure of conversations at least cost.

A conversation's rows, by turn, are edited until their role initials read
``(s?(ua)+)?``. Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of an
empty turn 3; blank rows and repeats of an earlier (role, text) are always
deleted, a truncated row that stays costs 3 more. Among the cheapest repairs the
one whose audit (the initials of its edits, in order) is least in ASCII is taken.

Method: a backward cost DP over (row, grammar state) leaves the optimal arcs; the
nodes are then ranked by their least audit of 1, 2, 4, ... letters: the rank at
twice a length is the rank of the pair (own rank, rank of the node the pointer of
that length leads to), and the pointers double with it. Arcs out of one node carry
different letters, so a node's least arc is known at length one; the doubled
pointers then lay out the whole path in as many steps as its length has bits.

Spark: rows are range-partitioned by (conversation, turn, role, text hash, row) and
stream through the tasks. A conversation inside one range is solved there, many
at once. The first and last conversation of a range, and any longer than
``HOLD`` rows, are handed on: their rows are numbered in order, cut into segments of
at most ``HOLD`` rows, each segment is a 4x4 matrix of least costs (min, plus), and
only these matrices (a few numbers for each segment) meet on the driver, which
gives every segment the costs at its end and the state at its start. So no task
holds more than a segment, whatever one conversation's share of the table. Only
SHA-256, which has no parallel form, reads such a conversation's repaired lines in one
task, as a stream of constant memory.

Defined results: null role or text is one space; null turns come first, null
conversation ids are one conversation; rows of one turn are ordered by role, then
by the text's 64-bit hash; repeated rows are duplicates; a role without an initial
s, u or a (upper case and empty ones too) cannot be kept; a conversation whose rows
are all gone has zeros, an empty audit and the hash of the empty string; an empty
table gives an empty result; very long texts are read whole; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from appraise.llm.common import NO_ID, batch_of, cut, id_of, real_id, shuffle_width

HOLD = 1 << 16              # rows of one conversation that a task holds at most
BATCH = 1 << 13             # rows solved together
STRIP = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NONE = 1 << 40              # a cost that no repair has

# Grammar states: nothing yet, after system, after user, after assistant. NEXT is where
# a user or assistant turn leads (a user after assistant, an assistant after user).
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
LETTERS = "DIKR"            # in ASCII order: codes 1 to 4, 0 ends an audit
END_COSTS = np.array([0, 2 * INSERT, INSERT, 0])
KEPT_TO = np.full((4, 4), -1)                       # initial (s, u, a, other) x state
KEPT_TO[0, START] = SYSTEM
KEPT_TO[1, [START, SYSTEM, ASSISTANT]] = USER
KEPT_TO[2, USER] = ASSISTANT


def damage(conversations: DataFrame) -> DataFrame:
    """Faults by crc32(``conv_id:turn``) % 20: ``conv_id, turn, role, text, gone``.

    0 drops the row (``gone``), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats
    it, 4 makes its role user. Nulls count as one space.
    """
    space = F.lit(" ")
    part = [F.coalesce(F.col(f"`{c}`").cast("string"), space) for c in ("conv_id", "turn")]
    d = conversations.select(
        F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"),
        F.coalesce(F.col("`role`").cast("string"), space).alias("role"),
        F.coalesce(F.col("`text`").cast("string"), space).alias("text"),
        (F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20).alias("_kind"))
    times = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return d.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("_kind") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


# Cost DP, ranks and paths of many conversations (or segments) at once

def _levels(initial, doomed, cut_off, lengths, ends):
    """Backward DP over lanes: costs at the first row, and letter and target of every node's least optimal arc.

    ``initial, doomed, cut_off`` are (rows, lanes), padded after a lane's own length;
    ``ends`` (lanes, 4) holds the costs behind the last row. Node (i, lane, state) has the
    number (i * lanes + lane) * 4 + state.
    """
    m, lanes = initial.shape
    letter = np.zeros((m + 1, lanes, 4), np.int8)
    target = np.arange((m + 1) * lanes * 4).reshape(m + 1, lanes, 4)
    cost = ends.astype(np.int64).copy()
    states = np.arange(4)
    own = np.arange(lanes)[:, None]
    for i in range(m - 1, -1, -1):
        live = i < lengths
        stay = np.where(doomed[i], NONE, np.where(cut_off[i], TRUNCATED, 0))[:, None]
        to = KEPT_TO[initial[i]]
        keep = np.where(to >= 0, stay + KEEP + cost[own, to], NONE)
        rerole = stay + REROLE + cost[:, NEXT]
        delete = DELETE + cost
        least = np.minimum(np.minimum(delete, keep), rerole)
        now = np.minimum(least, INSERT + least[:, NEXT])
        now[:, :2] = np.minimum(least[:, :2], INSERT + now[:, [USER]])
        insert = INSERT + now[:, NEXT]
        pick = np.select([delete == now, insert == now, keep == now], [1, 2, 3], 4)
        below = ((i + 1) * lanes + own) * 4
        arcs = np.choose(pick - 1, [below + states, (i * lanes + own) * 4 + NEXT, below + np.maximum(to, 0), below + NEXT])
        letter[i] = np.where(live[:, None], pick, 0)
        target[i] = np.where(live[:, None], arcs, target[i])
        cost = np.where(live[:, None], now, cost)
    return cost, letter, target


def _end_inserts(letter, target, lengths):
    """The inserts behind a conversation's last row: an assistant after user, a pair after system."""
    lanes = len(lengths)
    base = (lengths * lanes + np.arange(lanes)) * 4
    for state, to in ((SYSTEM, USER), (USER, ASSISTANT)):
        letter.reshape(-1)[base + state] = 2
        target.reshape(-1)[base + state] = base + to


def ranked(letter: np.ndarray, target: np.ndarray, longest: int):
    """Ranks of nodes by their least audit of 1, 2, 4, ... letters, and the pointers of each length."""
    rank, pointer = letter.reshape(-1).astype(np.int64), target.reshape(-1)
    pointers, length = [pointer], 1
    while length < longest:
        pair = rank * (int(rank.max()) + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
        length *= 2
    return rank, pointers


def paths(starts: np.ndarray, pointers: list[np.ndarray]) -> np.ndarray:
    """Nodes of each start's least path, laid out by the doubled pointers (lanes, 2^levels)."""
    nodes = starts[:, None]
    for pointer in pointers:
        nodes = np.concatenate([nodes, pointer[nodes]], axis=1)
    return nodes


def solve(groups, ends=None, starts=None):
    """Per group of (initial, doomed, cut_off) arrays: (cost, exit state, letters, rows, states).

    ``ends`` are the costs behind each group (default: the end of a conversation),
    ``starts`` its entry states. ``rows`` is the row each edit stands at.
    """
    out = [None] * len(groups)
    by_bits: dict[int, list[int]] = {}
    for g, (initial, _, _) in enumerate(groups):
        by_bits.setdefault(len(initial).bit_length(), []).append(g)
    for members in by_bits.values():
        lengths = np.array([len(groups[g][0]) for g in members])
        lanes, m = len(members), int(lengths.max())
        grid = np.zeros((3, m, lanes), np.int64)
        for lane, g in enumerate(members):
            for f in range(3):
                grid[f, :lengths[lane], lane] = groups[g][f]
        close = ends is None
        end = np.tile(END_COSTS, (lanes, 1)) if close else np.array([ends[g] for g in members])
        cost, letter, target = _levels(grid[0], grid[1] > 0, grid[2] > 0, lengths, end)
        if close:
            _end_inserts(letter, target, lengths)
        entry = np.zeros(lanes, np.int64) if starts is None else np.array([starts[g] for g in members])
        _, pointers = ranked(letter, target, 2 * m + 3)
        nodes = paths(np.arange(lanes) * 4 + entry, pointers)
        letters = letter.reshape(-1)[nodes]
        steps = (letters > 0).sum(1)
        for lane, g in enumerate(members):
            n = steps[lane]
            mine = nodes[lane, :n]
            out[g] = (int(cost[lane, entry[lane]]), int(nodes[lane, -1]) % 4, letters[lane, :n], mine // 4 // lanes, mine % 4)
    return out


def matrix(group) -> np.ndarray:
    """Least costs of a segment from each entry state to each exit state (4, 4)."""
    initial, doomed, cut_off = (np.asarray(x)[:, None].repeat(4, 1) for x in group)
    ends = np.where(np.eye(4, dtype=bool), 0, NONE)
    cost, _, _ = _levels(initial.astype(np.int64), doomed > 0, cut_off > 0, np.full(4, len(initial)), ends)
    return np.minimum(cost.T, NONE)


def edited(solution, role, text):
    """(letter, role, text) of every edit; a deleted row has no role."""
    _, _, letters, rows, states = solution
    for code, row, state in zip(letters.tolist(), rows.tolist(), states.tolist()):
        if code == 1:
            yield "D", None, None
        elif code == 3:
            yield "K", role[row], text[row]
        else:
            yield LETTERS[code - 1], "assistant" if state == USER else "user", "" if code == 2 else text[row]


# Streaming over the ordered rows

OUT = pa.schema([("kind", pa.int8()), ("conv", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()),
                 ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
                 ("audit", pa.string()), ("sha", pa.string()), ("seq", pa.int64()), ("turn", pa.int64()),
                 ("role", pa.string()), ("text", pa.string()), ("flags", pa.int64())])
OUT_DDL = ("kind byte, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, sha string, seq long, turn long, role string, text string, flags long")
SUMMARY, PENDING, LINE = 0, 1, 2
LEGAL = {(0, 1), (1, 2), (2, 1)}        # su, ua, au
BLANK_BIT, CUT_BIT, GONE_BIT = 4, 8, 16  # beside the initial in the two lowest bits


def _first_faults(rows):
    """Blank, duplicate and truncated per row, the first that holds."""
    seen, out = set(), []
    for _, role, text, flags in rows:
        blank = bool(flags & BLANK_BIT)
        repeat = not blank and (role, text) in seen
        seen.add((role, text))
        out.append((blank, repeat, not blank and not repeat and bool(flags & CUT_BIT)))
    return out


def _finished(convs, lines: bool):
    """Output rows of whole conversations: lists of (conv, rows), rows being (turn, role, text, flags)."""
    faults = [_first_faults(rows) for _, rows in convs]
    groups = [([r[3] & 3 for r in rows], [b or d for b, d, _ in f], [t for _, _, t in f])
              for (_, rows), f in zip(convs, faults)]
    for (conv, rows), fault, group, done in zip(convs, faults, groups, solve(groups)):
        edits = list(edited(done, [r[1] for r in rows], [r[2] for r in rows]))
        if lines:
            kept = [e for e in edits if e[1] is not None]
            for place, (how, role, text) in enumerate(kept):
                yield (LINE, conv, *[None] * 6, how, None, place, None, role, text, None)
            continue
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        blank, repeat, cut_off = (sum(f[k] for f in fault) for k in range(3))
        initial = group[0]
        illegal = sum(pair not in LEGAL for pair in zip(initial, initial[1:]))
        whole = "\n".join(f"{role}:{text}" for _, role, text in edits if role is not None)
        yield (SUMMARY, conv, gaps, blank, repeat, cut_off, illegal, done[0], "".join(e[0] for e in edits),
               hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), *[None] * 5)


def _stream(lines: bool, hold: int):
    """Solve the conversations inside a range; hand on those at its edges and the very long ones."""
    def run(batches):
        part = TaskContext.get().partitionId() << 40
        state = {"n": 0, "first": True}
        ready, buffer, held = [], [], []

        def pend(conv, rows):
            for turn, role, text, flags in rows:
                buffer.append((PENDING, conv, *[None] * 8, part + state["n"], turn, role, text, flags))
                state["n"] += 1

        def close(conv, rows):
            if state["first"] or state["long"]:
                pend(conv, rows)
            else:
                ready.append((conv, [r for r in rows if not r[3] & GONE_BIT]))
            state["first"] = state["long"] = False

        current, state["long"] = None, False
        for b in batches:
            for conv, *row in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "flags"))):
                if conv != current:
                    if current is not None:
                        close(current, held)
                    current, held = conv, []
                held.append(tuple(row))
                if len(held) >= hold:
                    pend(current, held)
                    held, state["long"] = [], True
            if sum(len(r) for _, r in ready) >= BATCH:
                buffer.extend(_finished(ready, lines))
                ready = []
            if len(buffer) >= BATCH:
                yield batch_of(OUT, list(zip(*buffer)))
                buffer = []
        if current is not None:
            pend(current, held)         # the last one may go on in the next range
        buffer.extend(_finished(ready, lines))
        for s in range(0, len(buffer), BATCH):
            yield batch_of(OUT, list(zip(*buffer[s:s + BATCH])))
    return run


# Conversations that cross ranges, or are longer than a task may hold

SEGMENT = pa.schema([("conv", pa.int64()), ("seg", pa.int64()), ("costs", pa.list_(pa.int64())),
                     ("exits", pa.list_(pa.int64()))])
SEGMENT_DDL = "conv long, seg long, costs array<long>, exits array<long>"


def _segments(batches, names):
    """(conv, seg, rows) of rows that come sorted by (conv, seq)."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in names)):
            if row[:2] != key:
                if rows:
                    yield *key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield *key, rows


def _group(rows):
    return [r[3] & 3 for r in rows], [bool(r[4]) for r in rows], [bool(r[5]) for r in rows]


def _matrices(batches):
    for conv, seg, rows in _segments(batches, ("conv", "seg", "seq", "flags", "doomed", "late")):
        yield batch_of(SEGMENT, [[conv], [seg], [matrix(_group(rows)).ravel().tolist()], [[]]])


def _exits(batches):
    """Exit state for each entry state, the costs at the segment's end being known."""
    for conv, seg, rows in _segments(batches, ("conv", "seg", "seq", "flags", "doomed", "late", "ends")):
        done = solve([_group(rows)] * 4, [rows[0][6]] * 4, range(4))
        yield batch_of(SEGMENT, [[conv], [seg], [[d[0] for d in done]], [[d[1] for d in done]]])


PIECE = pa.schema([("conv", pa.int64()), ("seq", pa.int64()), ("sub", pa.int64()), ("how", pa.string()),
                   ("role", pa.string()), ("text", pa.string())])
PIECE_DDL = "conv long, seq long, sub long, how string, role string, text string"


def _edits(batches):
    names = ("conv", "seg", "seq", "flags", "doomed", "late", "ends", "entry", "last", "role", "text")
    for _, _, rows in _segments(batches, names):
        done = solve([_group(rows)], [rows[0][6]], [rows[0][7]])[0]
        edits = list(edited(done, [r[9] for r in rows], [r[10] for r in rows]))
        if rows[0][8]:                  # the conversation ends here
            state = done[1]
            while state in (SYSTEM, USER):
                edits.append(("I", "assistant" if state == USER else "user", ""))
                state = int(NEXT[state])
        conv, first = rows[0][0], rows[0][2]
        for s in range(0, len(edits), BATCH):
            chunk = edits[s:s + BATCH]
            yield batch_of(PIECE, [[conv] * len(chunk), [first] * len(chunk), list(range(s, s + len(chunk))),
                                   *map(list, zip(*chunk))])


def _ends_and_entries(spark, segs: DataFrame, rows: DataFrame):
    """Costs behind and state before every segment, from the segments' matrices."""
    mats = sorted((r.conv, r.seg, np.array(r.costs).reshape(4, 4)) for r in segs.collect())
    ends, after = [], END_COSTS
    for k in range(len(mats) - 1, -1, -1):
        last = k + 1 == len(mats) or mats[k + 1][0] != mats[k][0]
        after = END_COSTS if last else after
        ends.append((mats[k][0], mats[k][1], [int(c) for c in after], last))
        after = np.minimum((mats[k][2] + after[None, :]).min(1), NONE)
    known = spark.createDataFrame(ends, "conv long, seg long, ends array<long>, last boolean")
    dealt = _dealt(rows.join(known, ["conv", "seg"]))
    exits = sorted((r.conv, r.seg, r.costs, r.exits) for r in dealt.mapInArrow(_exits, SEGMENT_DDL).collect())
    entries, costs, conv, state = [], [], None, START
    for c, seg, cost, out in exits:
        if c != conv:
            conv, state = c, START
            costs.append((c, cost[START]))
        entries.append((c, seg, state))
        state = out[state]
    return (known.join(spark.createDataFrame(entries, "conv long, seg long, entry long"), ["conv", "seg"]),
            spark.createDataFrame(costs, "conv long, cost long"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_width(rows.sparkSession), "conv", "seg").sortWithinPartitions("conv", "seq")


def _hashed(batches):
    """One stream of a conversation's edits after the other: the hash and the audit of each."""
    current, digest, audit, first = None, None, [], True
    schema = pa.schema([("conv", pa.int64()), ("audit", pa.string()), ("sha", pa.string())])
    for b in batches:
        for conv, how, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "how", "role", "text"))):
            if conv != current:
                if current is not None:
                    yield batch_of(schema, [[current], ["".join(audit)], [digest.hexdigest()]])
                current, digest, audit, first = conv, hashlib.sha256(), [], True
            audit.append(how)
            if role is not None:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
    if current is not None:
        yield batch_of(schema, [[current], ["".join(audit)], [digest.hexdigest()]])


def _long(pending: DataFrame, lines: bool, hold: int) -> DataFrame:
    """The conversations handed on: by segments, with duplicates found by a folded count."""
    spark = pending.sparkSession
    alive = pending.where(F.col("flags").bitwiseAND(GONE_BIT) == 0)
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = alive.select("conv", "seq", "turn", "role", "text", "flags", key.alias("key"))
    first = rows.groupBy("conv", "key").agg(F.min("seq").alias("first"))
    blank = F.col("flags").bitwiseAND(BLANK_BIT) > 0
    repeat = ~blank & (F.col("seq") > F.col("first"))
    rows = cut(rows.join(first, ["conv", "key"]).select(
        "conv", "seq", F.floor(F.col("seq") / hold).cast("long").alias("seg"), "turn", "role", "text", "flags",
        blank.alias("blank"), repeat.alias("repeat"), (blank | repeat).alias("doomed"),
        (~blank & ~repeat & (F.col("flags").bitwiseAND(CUT_BIT) > 0)).alias("late")), "repair-long")
    segs = _dealt(rows.drop("text")).mapInArrow(_matrices, SEGMENT_DDL)
    known, costs = _ends_and_entries(spark, segs, rows.drop("text"))
    pieces = _dealt(rows.join(known, ["conv", "seg"])).mapInArrow(_edits, PIECE_DDL)
    if lines:
        kept = cut(pieces.where("role IS NOT NULL"), "repair-lines")
        before = kept.groupBy("conv", "seq").agg(F.count("*").alias("n")).select("conv", "seq", F.coalesce(
            F.sum("n").over(Window.partitionBy("conv").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        order = F.row_number().over(Window.partitionBy("conv", "seq").orderBy("sub"))
        return kept.join(before, ["conv", "seq"]).select(
            "conv", (F.col("before") + order - 1).alias("place"), "role", "text", F.col("how").alias("edit"))
    whole = (pieces.repartition(shuffle_width(spark), "conv").sortWithinPartitions("conv", "seq", "sub")
             .mapInArrow(_hashed, "conv long, audit string, sha string"))
    one = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    counts = rows.groupBy("conv").agg(one("blank"), one("repeat"), one("late"))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    initial = F.col("flags").bitwiseAND(3)
    edge = rows.groupBy("conv", "seg").agg(F.min_by(initial, "seq").alias("head"), F.max_by(initial, "seq").alias("tail"))
    legal = lambda a, b: ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    inner = rows.select("conv", "seg", initial.alias("b"), F.lag(initial).over(Window.partitionBy("conv", "seg").orderBy("seq")).alias("a"))
    outer = edge.select("conv", F.col("head").alias("b"), F.lag("tail").over(Window.partitionBy("conv").orderBy("seg")).alias("a"))
    wrong = inner.select("conv", "a", "b").unionByName(outer.select("conv", "a", "b")).where("a IS NOT NULL").groupBy(
        "conv").agg(F.sum((~legal(F.col("a"), F.col("b"))).cast("long")).alias("illegal"))
    ids = pending.select("conv").distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    out = ids
    for part in (counts, turns, wrong, costs, whole):
        out = out.join(part, "conv", "left")
    return out.select("conv", zero("gaps").alias("gaps"), zero("blank").alias("blank"), zero("repeat").alias("duplicate"),
                      zero("late").alias("truncated"), zero("illegal").alias("illegal"), zero("cost").alias("cost"),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("sha"))


def _solved(conversations: DataFrame, gone_col: str | None, lines: bool, hold: int,
            ranges: int | None) -> tuple[DataFrame, DataFrame]:
    spark = conversations.sparkSession
    gone = F.coalesce(F.col(f"`{gone_col}`"), F.lit(False)) if gone_col else F.lit(False)
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in ("role", "text"))
    d = conversations.select(id_of("conv_id").alias("conv"), F.col("`turn`").cast("long").alias("turn"),
                             role.alias("role"), text.alias("text"), gone.alias("_gone"))
    start, bare = F.substring("role", 1, 1), F.rtrim(F.col("text"), F.lit(STRIP))
    initial = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(3)
    flag = lambda c, bit: F.when(c, bit).otherwise(0)
    flags = (initial + flag(bare == "", BLANK_BIT) + flag(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT_BIT)
             + flag(F.col("_gone"), GONE_BIT)).cast("long")
    order = ("conv", "_t", "role", "_th", "_row")
    rows = d.select("conv", "turn", "role", "text", flags.alias("flags"), F.coalesce("turn", F.lit(NO_ID)).alias("_t"),
                    F.xxhash64("text").alias("_th"), F.monotonically_increasing_id().alias("_row"))
    out = cut(rows.repartitionByRange(ranges or 2 * shuffle_width(spark), *order).sortWithinPartitions(*order)
              .select("conv", "turn", "role", "text", "flags").mapInArrow(_stream(lines, hold), OUT_DDL), "repair")
    return out, out.where(F.col("kind") == PENDING).select("conv", "seq", "turn", "role", "text", "flags")


def repair(conversations: DataFrame, gone_col: str | None = None, hold: int = HOLD,
           ranges: int | None = None) -> DataFrame:
    """One row per conversation: faults, cost, audit and the repaired text's hash.

    Takes ``conv_id, turn, role, text``; rows for which the boolean ``gone_col`` is true
    only say that their conversation exists.
    """
    out, pending = _solved(conversations, gone_col, False, hold, ranges)
    names = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha")
    done = out.where(F.col("kind") == SUMMARY).select(*names).unionByName(_long(pending, False, hold).select(*names))
    return done.select(real_id("conv").alias("conv_id"), *names[1:-1], F.col("sha").alias("repaired_sha256"))


def repaired(conversations: DataFrame, gone_col: str | None = None, hold: int = HOLD,
             ranges: int | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit`` (K, R or I)."""
    out, pending = _solved(conversations, gone_col, True, hold, ranges)
    done = out.where(F.col("kind") == LINE).select("conv", F.col("seq").alias("place"), "role", "text",
                                                   F.col("audit").alias("edit"))
    done = done.unionByName(_long(pending, True, hold))
    return done.select(real_id("conv").alias("conv_id"), "place", "role", "text", "edit")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and their cheapest repair."""
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "gone")
