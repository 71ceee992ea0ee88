"""Personal data: fixed patterns plus a character-level BiLSTM with CRF transitions.

The patterns give the base spans. The model is trained in numpy on the driver from a
bounded sample of labelled documents (``TRAIN_DOCS`` with and as many without a
digit or ``@``, those of smallest hash): windows whose labels are the base spans,
plain prose, prose with numbers that are nobody's, and prose into which spans
spelled otherwise are set (``(at)``, ``dot``, spaces, other separators), made from
the base spans found and from made-up ones. It then reads the whole of every text.

Reading: windows overlap; both directions run as one batch, each from its own
end, over tables of 98 rows that hold the input weights. Every window is followed by one
outside position. A window whose outside labels provably win (a bound from the
emissions and the transitions) needs no decoding; the others get Viterbi tags
and marginals. A span cut by a window's edge is joined with the pieces that its
neighbours found of it. The document's spans are then reconciled globally: equal spans
from several windows add their weights and the heaviest set of spans that
do not overlap each other or a base span is kept; equal weights go to the set
found first by end, then start, then kind.

Null and empty texts have no spans. Rows with a null id and repeated rows are read like
others. Long texts are cut into windows, never shortened. Empty tables give empty
results; other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from appraise.llm.common import batch_of, binary_rows, documents, id_of, one_thread, real_id, text_of

KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits are tried once, from their first digit: linear in the text.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WINDOW, STRIDE = 1024, 960
BATCH_WINDOWS = 512             # windows read at a time
TRAIN_WINDOW = 96
TRAIN_DOCS = 1500               # of either sort: the bound of the labelled sample
STEPS, BATCH, HIDDEN, EMBED = 500, 64, 8, 12
MIN_CONFIDENCE = 0.75           # mean probability of a span's labels
MIN_LENGTH = {"email": 6, "ip": 7, "card": 12, "phone": 8}
N_TAGS = 1 + 2 * len(KINDS)     # O, then B and I of each kind
N_CHARS = 98                    # 32..126, newline and tab, other letters, padding


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outward."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() and c.isascii() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


# --- the tagger -----------------------------------------------------------

def char_ids(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where((c >= 32) & (c < 127), c - 32, np.where(c < 32, 95, 96))


def all_starts(text: str) -> list[int]:
    """Starts of overlapping windows over the whole text."""
    return list(range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE)) if text else []


def tags_of(spans: list[tuple[int, int, int]], start: int, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for s, k, e in spans:
        a, b = max(s, start), min(e, start + size)
        if a < b:
            out[a - start:b - start] = 2 + 2 * k
            if s >= start:
                out[s - start] = 1 + 2 * k
    return out


# --- lessons: labelled windows ----------------------------------------------

AT = (" (at) ", "(at)", " [at] ", "[at]", " at ", " AT ", " {at} ", " @ ", "_at_")
DOT = (" (dot) ", " [dot] ", " dot ", "[dot]", "(dot)", " . ", " DOT ", "_dot_")
IP_DOT = ("[.]", " . ", "(.)", " dot ", "[dot]", ". ")
CARD_GAP = (".", "/", "_", "  ", " - ", " / ")
PHONE_GAP = ("/", "_", " / ", "//")


def _word(r: random.Random, low: int = 3, high: int = 9) -> str:
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(low, high)))


def _card(r: random.Random) -> str:
    digits = [r.randint(0, 9) for _ in range(r.choice((15, 16, 16, 19)))]
    last = sum(n - 9 if (n := d * (2 if i % 2 == 0 else 1)) > 9 else n for i, d in enumerate(reversed(digits)))
    return "".join(map(str, digits)) + str(-last % 10)


def invented(r: random.Random, kind: int) -> str:
    """A base span of a kind with nobody behind it."""
    if kind == 0:
        return f"{_word(r)}{r.choice(('', '.', '_'))}{_word(r, 2, 6)}@{_word(r)}.{r.choice(('com', 'org', 'net', 'de', 'fr', 'io'))}"
    if kind == 1:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        return _card(r)
    return f"+{r.randint(1, 99)} {r.randint(10, 9999)} {r.randint(1000, 9999999)}"


def disguise(r: random.Random, kind: int, value: str) -> str:
    """A base span spelled so that the patterns miss it."""
    if kind == 0:
        local, _, domain = value.partition("@")
        dot = r.choice(DOT)
        return (local.replace(".", dot) if r.random() < 0.3 else local) + r.choice(AT) + dot.join(domain.split("."))
    if kind == 1:
        return r.choice(IP_DOT).join(value.split("."))
    digits = re.sub("[^0-9]", "", value)
    if kind == 2:
        return r.choice(CARD_GAP).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    gap, at, parts = r.choice(PHONE_GAP), r.randint(1, 3), []
    while at < len(digits):
        step = r.randint(2, 4)
        parts.append(digits[at:at + step])
        at += step
    return r.choice(("+", "00", "+")) + digits[:len(digits) - sum(map(len, parts))] + gap + gap.join(parts)


def harmless(r: random.Random) -> str:
    """Numbers and words that look like personal data and are none."""
    n = r.randint
    return r.choice((
        f"{n(1, 31)}.{n(1, 12)}.{n(1900, 2030)}", f"{n(0, 23)}:{n(10, 59)}", f"{n(1, 9)}.{n(0, 99)}", f"{n(1, 999)},{n(100, 999)}.{n(10, 99)}",
        f"{n(1900, 2030)}-{n(10, 12)}-{n(10, 28)}", f"{n(1, 9)}.{n(0, 9)}.{n(0, 20)}", f"{n(10, 99)}/{n(10, 99)}", f"{n(1000, 99999999)}",
        f"at {n(1, 12)}", f"{_word(r)} at {_word(r)}", f"the dot {_word(r)}", f"{n(10, 99)} - {n(10, 99)}", f"({n(1, 99)})", f"{n(1, 99)} %"))


def _set_in(r: random.Random, prose: str, insert: str) -> tuple[str, int]:
    """A window of prose with the insert somewhere, now and then over an edge; where it starts."""
    at = r.randint(-len(insert) // 3, TRAIN_WINDOW - 2 * len(insert) // 3) if r.random() < 0.2 else \
        r.randint(0, max(0, TRAIN_WINDOW - len(insert)))
    gap = r.choice((" ", " ", "\n", ": ", ", ", " ("))
    left, right = (prose[:max(0, at)] + gap)[-max(0, at):] if at > 0 else "", r.choice((" ", ". ", ", ", "\n", ")")) + prose[max(0, at):]
    whole = left + insert[max(0, -at):] + right
    return whole[:TRAIN_WINDOW].ljust(TRAIN_WINDOW, "\n"), at


def lessons(texts: list[str], seed: int = 7) -> list[tuple[str, np.ndarray]]:
    """Labelled windows made from a sample of texts."""
    r, out, seen, prose = random.Random(seed), [], [[], [], [], []], []
    for text in texts:
        base = base_spans(text)
        for s, k, e in base[:20]:
            seen[k].append(text[s:e])
        for s, _, e in base[:3]:
            at = max(0, min(s - r.randint(0, TRAIN_WINDOW // 2), len(text) - TRAIN_WINDOW))
            out.append((text[at:at + TRAIN_WINDOW].ljust(TRAIN_WINDOW, "\n"), tags_of(base, at, TRAIN_WINDOW)))
        at = r.randint(0, max(0, len(text) - TRAIN_WINDOW))
        window = text[at:at + TRAIN_WINDOW].ljust(TRAIN_WINDOW, "\n")
        out.append((window, tags_of(base, at, TRAIN_WINDOW)))
        if not out[-1][1].any():
            prose.append(window)
    for i in range(2 * len(prose)):
        if i % 3 == 2:
            out.append((_set_in(r, r.choice(prose), harmless(r))[0], np.zeros(TRAIN_WINDOW, np.int64)))
            continue
        kind = i % 4
        value = disguise(r, kind, r.choice(seen[kind]) if seen[kind] and r.random() < 0.5 else invented(r, kind))
        window, at = _set_in(r, r.choice(prose), value)
        out.append((window, tags_of([(at, kind, at + len(value))], 0, TRAIN_WINDOW)))
    return out


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    m = {"emb": r.normal(0, 0.3, (N_CHARS, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, N_TAGS)),
         "bias": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS, N_TAGS))}
    for d in "fb":
        m["w" + d] = r.normal(0, 0.2, (EMBED, 4 * HIDDEN))
        m["u" + d] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        m["b" + d] = np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN)))    # forget gate open
    return {k: v.astype(np.float32) for k, v in m.items()}


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, B, H) for inputs already through their weights (T, B, 4H)."""
    t, b, _ = x.shape
    h = c = np.zeros((b, HIDDEN), x.dtype)
    out = np.empty((t, b, HIDDEN), x.dtype)
    for i in range(t):
        g = x[i] + h @ u
        s = _sigmoid(g[:, :3 * HIDDEN])
        f, n, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        a = np.tanh(g[:, 3 * HIDDEN:])
        last_h, last_c = h, c
        c = f * c + n * a
        th = np.tanh(c)
        h = o * th
        out[i] = h
        if keep is not None:
            keep.append((f, n, o, a, th, last_h, last_c))
    return out


def _lstm_back(grad: np.ndarray, u: np.ndarray, kept: list):
    """Gradients of the inputs (T, B, 4H) and of the recurrent weights."""
    dx = np.empty((*grad.shape[:2], 4 * HIDDEN), grad.dtype)
    du, dh, dc = np.zeros_like(u), 0, 0
    for i in range(len(grad) - 1, -1, -1):
        f, n, o, a, th, last_h, last_c = kept[i]
        dh = grad[i] + dh
        dc = dc + dh * o * (1 - th * th)
        dx[i] = np.concatenate((dc * last_c * f * (1 - f), dc * a * n * (1 - n),
                                dh * th * o * (1 - o), dc * n * (1 - a * a)), axis=1)
        du += last_h.T @ dx[i]
        dh, dc = dx[i] @ u.T, dc * f
    return dx, du


def emissions(m: dict, ids: np.ndarray, kept: dict | None = None) -> np.ndarray:
    """(T, B, tags) scores of windows (B, T)."""
    x = m["emb"][ids.T]
    kf, kb = ([], []) if kept is not None else (None, None)
    hf = _lstm(x @ m["wf"] + m["bf"], m["uf"], kf)
    hb = _lstm((x @ m["wb"] + m["bb"])[::-1], m["ub"], kb)[::-1]
    h = np.concatenate((hf, hb), axis=2)
    if kept is not None:
        kept.update(x=x, kf=kf, kb=kb, h=h)
    return h @ m["out"] + m["bias"]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def marginals(em: np.ndarray, trans: np.ndarray):
    """Tag probabilities (T, B, tags), forward scores, backward scores, log partition."""
    t = len(em)
    fwd, bwd = np.empty_like(em), np.zeros_like(em)
    fwd[0] = em[0]
    for i in range(1, t):
        fwd[i] = em[i] + _logsum(fwd[i - 1][:, :, None] + trans[None], 1)
    for i in range(t - 2, -1, -1):
        bwd[i] = _logsum((em[i + 1] + bwd[i + 1])[:, None, :] + trans[None], 2)
    z = _logsum(fwd[-1], 1)
    return np.exp(fwd + bwd - z[None, :, None]), fwd, bwd, z


def viterbi(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags (B, T)."""
    t, b, _ = em.shape
    back, score = np.zeros(em.shape, np.int64), em[0]
    for i in range(1, t):
        all_ = score[:, :, None] + trans[None]
        back[i] = all_.argmax(axis=1)
        score = all_.max(axis=1) + em[i]
    tags = np.empty((b, t), np.int64)
    tags[:, -1] = score.argmax(axis=1)
    rows = np.arange(b)
    for i in range(t - 1, 0, -1):
        tags[:, i - 1] = back[i][rows, tags[:, i]]
    return tags


def gradients(m: dict, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of the tags (B, T) and its gradients."""
    kept: dict = {}
    em = emissions(m, ids, kept)
    t, b, k = em.shape
    p, fwd, bwd, z = marginals(em, m["trans"])
    g = gold.T
    steps, lanes = np.arange(t)[:, None], np.arange(b)[None]
    path = em[steps, lanes, g].sum(0) + m["trans"][g[:-1], g[1:]].sum(0)
    d_em = p.copy()
    d_em[steps, lanes, g] -= 1
    pair = np.exp(fwd[:-1, :, :, None] + m["trans"] + (em[1:] + bwd[1:])[:, :, None, :] - z[None, :, None, None])
    d_trans = pair.sum((0, 1))
    np.subtract.at(d_trans, (g[:-1].ravel(), g[1:].ravel()), 1)
    d_em, d_trans = d_em / b, d_trans / b
    h = kept["h"]
    out = {"trans": d_trans, "out": h.reshape(-1, 2 * HIDDEN).T @ d_em.reshape(-1, k), "bias": d_em.sum((0, 1))}
    dh = d_em @ m["out"].T
    x = kept["x"].reshape(-1, EMBED)
    dxf, out["uf"] = _lstm_back(dh[:, :, :HIDDEN], m["uf"], kept["kf"])
    dxb, out["ub"] = _lstm_back(dh[::-1, :, HIDDEN:], m["ub"], kept["kb"])
    dxb = dxb[::-1]
    d_emb = np.zeros_like(m["emb"])
    for d, dx in (("f", dxf), ("b", dxb)):
        flat = dx.reshape(-1, 4 * HIDDEN)
        out["w" + d], out["b" + d] = x.T @ flat, flat.sum(0)
        np.add.at(d_emb, ids.T.ravel(), flat @ m["w" + d].T)
    out["emb"] = d_emb
    return float((z - path).mean()), out


def train(windows: list[tuple[str, np.ndarray]], steps: int = STEPS, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on seeded batches of labelled windows (text, tags) of equal length."""
    m = new_model(seed)
    if not windows:
        return m
    ids = np.stack([char_ids(t) for t, _ in windows])
    gold = np.array([g for _, g in windows], np.int64)
    r = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    mean, n_mean = {k: np.zeros_like(v) for k, v in m.items()}, 0
    for step in range(1, steps + 1):
        pick = r.integers(0, len(ids), min(BATCH, len(ids)))
        _, grads = gradients(m, ids[pick], gold[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 4 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            m[k] -= (rate * first[k] / (1 - 0.9 ** step)
                     / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        if step > 0.8 * steps:              # the mean of the last weights swings less than any of them
            n_mean += 1
            for k, x in m.items():
                mean[k] += (x - mean[k]) / n_mean
    return mean


def read_emissions(m: dict, rows: list[np.ndarray]) -> np.ndarray:
    """(T + 1, B, tags) scores of windows of any lengths; behind its end a window is outside.

    Both directions are one batch and begin at the window's own ends, so a window's scores
    do not depend on the others. The sigmoids are taken as tanh of half the input,
    with the halves in the tables.
    """
    sizes = np.array([len(r) for r in rows])
    t, b, h = int(sizes.max()), len(rows), HIDDEN
    ids = np.full((2, t, b), N_CHARS - 1)
    for i, row in enumerate(rows):
        ids[0, :len(row), i], ids[1, :len(row), i] = row, row[::-1]
    # By gate: (4, direction, lane, unit) lies gate after gate, so every step works on whole blocks.
    half = np.array([0.5, 0.5, 0.5, 1], np.float32)[:, None, None]
    table = np.stack([(m["emb"] @ m["w" + d] + m["b" + d]).reshape(N_CHARS, 4, h).transpose(1, 0, 2) * half for d in "fb"], 1)
    table = np.ascontiguousarray(table.reshape(-1, h), np.float32)
    u = np.stack([m["u" + d].reshape(h, 4, h).transpose(1, 0, 2) * half for d in "fb"], 1).astype(np.float32)
    place = (np.arange(4)[:, None] * 2 + np.arange(2))[:, :, None] * N_CHARS
    state, cell = np.zeros((2, b, h), np.float32), np.zeros((2, b, h), np.float32)
    out = np.empty((t, 2, b, h), np.float32)
    g, through, squashed = np.empty((4, 2, b, h), np.float32), np.empty((4, 2, b, h), np.float32), np.empty_like(cell)
    gates, (keep, new, show, fresh) = g[:3], g
    for i in range(t):
        np.take(table, ids[:, i] + place, axis=0, out=g, mode="clip")
        g += np.matmul(state, u, out=through)
        np.tanh(g, out=g)
        gates *= 0.5
        gates += 0.5
        cell *= keep
        fresh *= new
        cell += fresh
        np.tanh(cell, out=squashed)
        state = np.multiply(show, squashed, out=out[i])
    both = out @ np.stack([m["out"][:h], m["out"][h:]]).astype(np.float32)
    em = np.empty((t + 1, b, N_TAGS), np.float32)
    outside = np.array([0, *[-1e4] * (N_TAGS - 1)], np.float32)
    em[t] = outside
    if sizes.min() == t:
        np.add(both[:, 0], both[::-1, 1], out=em[:t])
        em[:t] += m["bias"]
    else:
        at = sizes[None] - 1 - np.arange(t)[:, None]
        em[:t] = both[:, 0] + both[np.maximum(at, 0), 1, np.arange(b)] + m["bias"]
        for lane, size in enumerate(sizes):
            em[size:, lane] = outside
    return em


def may_hold_spans(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Windows where some path with a span could beat the outside path: an upper bound for each."""
    lead = em[:, :, 1].copy()
    for k in range(2, N_TAGS):
        np.maximum(lead, em[:, :, k], out=lead)
    lead -= em[:, :, 0]
    outside = trans[0, 0]
    enter, stay, leave = trans[0, 1:].max() - outside, trans[1:, 1:].max() - outside, trans[1:, 0].max() - outside
    run, top = lead[0].copy(), lead[0].copy()
    for i in range(1, len(em)):
        run += stay
        np.maximum(run, enter, out=run)
        run += lead[i]
        np.maximum(top, run, out=top)
    return top + leave > -1e-3


def decode(m: dict, rows: list[np.ndarray]) -> list[list[tuple[int, int, int, float]]]:
    """Per window of character ids: (start, kind, end, mean probability) of its tagged spans."""
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in rows]
    em = read_emissions(m, rows)
    some = np.flatnonzero(may_hold_spans(em, m["trans"]))
    if not len(some):
        return out
    em = em[:, some]
    tags = viterbi(em, m["trans"])
    marked = np.flatnonzero(tags.any(axis=1))
    p = marginals(em[:, marked], m["trans"])[0] if len(marked) else None
    for lane, w in enumerate(marked):
        row, at = tags[w], 0
        while at < len(rows[some[w]]):
            if not row[at]:
                at += 1
                continue
            kind, end = (row[at] - 1) // 2, at + 1
            while row[end] == 2 + 2 * kind:             # the position behind the window is outside
                end += 1
            out[some[w]].append((at, int(kind), end, float(p[np.arange(at, end), lane, row[at:end]].mean())))
            at = end
    return out


def reconcile(found: list[tuple[int, int, int, float]], base: list[tuple[int, int, int]]):
    """The heaviest set of (start, kind, end) that overlap neither each other nor a base span."""
    weight: dict[tuple[int, int, int], float] = {}
    for s, k, e, p in found:
        weight[s, k, e] = weight.get((s, k, e), 0.0) + p * (e - s)
    taken = sorted((s, e) for s, _, e in base)
    reach = list(accumulate((e for _, e in taken), max))        # furthest end up to each base span
    free = []
    for s, k, e in sorted(weight, key=lambda x: (x[2], x)):
        before = bisect_left(taken, (e,))                       # base spans that start before this one ends
        if not before or reach[before - 1] <= s:
            free.append((s, k, e))
    ends, best, pick = [e for _, _, e in free], [0.0], []
    for i, x in enumerate(free):
        j = bisect_right(ends, x[0], 0, i)
        use = best[j] + weight[x]
        pick.append((use > best[-1], j))
        best.append(max(best[-1], use))
    out, i = [], len(free)
    while i:
        use, j = pick[i - 1]
        if use:
            out.append(free[i - 1])
        i = j if use else i - 1
    return out[::-1]


def stitch(pieces: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Whole spans of (start, kind, end, probability, cut left, cut right) pieces of one text.

    Pieces cut by a window's edge are joined with those of their kind that they
    overlap or touch on that side; what stays cut on a side is left out, and the
    probability is the mean over the pieces' characters.
    """
    out = [x[:4] for x in pieces if not x[4] and not x[5]]
    for kind in {x[1] for x in pieces if x[4] or x[5]}:
        run: list = []
        for x in [*sorted(x for x in pieces if x[1] == kind and (x[4] or x[5])), None]:
            # Inside a run every piece but the last must go on to the right, the next one be cut on the left.
            if run and (x is None or x[0] > run[1] or not (run[4] and x[4])):
                if not run[3] and not run[4]:
                    out.append((run[0], kind, run[1], run[2][0] / run[2][1]))
                run = []
            if x is None:
                break
            s, _, e, p, left, right = x
            if not run:
                run = [s, e, [p * (e - s), e - s], left, right]
            else:
                run[2] = [run[2][0] + p * (e - s), run[2][1] + e - s]
                if e >= run[1]:
                    run[1], run[4] = e, right
    return out


def read_texts(m: dict, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans the model adds to each text's base spans."""
    bases = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]

    letters = [char_ids(t) for t in texts]

    def read(where):
        for (i, s), spans in zip(where, decode(m, [letters[i][s:s + WINDOW] for i, s in where])):
            size = len(texts[i])
            found[i] += [(s + a, k, s + e, p, a == 0 and s > 0, e == WINDOW and s + e < size) for a, k, e, p in spans]

    # Windows of like length together, so that few lanes wait for a longer one.
    every = sorted(((i, s) for i, t in enumerate(texts) for s in all_starts(t)),
                   key=lambda x: (-min(WINDOW, len(texts[x[0]]) - x[1]), x))
    for at in range(0, len(every), BATCH_WINDOWS):
        read(every[at:at + BATCH_WINDOWS])
    out = []
    for t, pieces, base in zip(texts, found, bases):
        whole = [(s, k, e, p) for s, k, e, p in stitch(pieces)
                 if p >= MIN_CONFIDENCE and e - s >= MIN_LENGTH[KINDS[k]] and t[s:e] == t[s:e].strip()]
        out.append(reconcile(whole, base))
    return out


RESULT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
RESULT_DDL = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
              "spans string, n_added long")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Train on lessons from about ``most`` documents of smallest hash that hold a digit or ``@``, and as many that do not.

    The hash below which a document is taken follows from their counts, so no more than
    about twice ``most`` texts reach the driver, however many tasks look for them.
    """
    rows = docs.select(text_of(text_col).alias("_text"), F.xxhash64(id_of(id_col), text_of(text_col)).alias("_rank")) \
        .where(F.col("_text") != "").withColumn("_some", F.col("_text").rlike("[0-9@]"))
    counts = {r["_some"]: r["count"] for r in rows.groupBy("_some").count().collect()}
    below = {some: min((1 << 63) - 1, int(min(1.0, most / n) * (1 << 64)) - (1 << 63)) for some, n in counts.items()}
    taken = rows.where(F.col("_rank") <= F.when(F.col("_some"), F.lit(below.get(True, 0))).otherwise(F.lit(below.get(False, 0))))
    one_thread()
    return train(lessons([r["_text"] for r in sorted(taken.collect(), key=lambda r: (r["_rank"], r["_text"]))]))


def find(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base spans by kind, their digest, all spans, and how many were added."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        one_thread()
        for b in batches:
            raw = list(binary_rows(b.column("_text")))
            live = [i for i, t in enumerate(raw) if t]
            cols = [b.column("_id").to_pylist(), *([0] * len(raw) for _ in KINDS),
                    [nothing] * len(raw), [""] * len(raw), [0] * len(raw)]
            texts = [raw[i].decode() for i in live]
            for i, text, more in zip(live, texts, read_texts(model, texts)):
                base = base_spans(text)
                for _, k, _ in base:
                    cols[1 + k][i] += 1
                cols[5][i] = hashlib.sha256(spell(base).encode()).hexdigest()
                cols[6][i], cols[7][i] = spell(base + more), len(more)
            yield batch_of(RESULT, cols)

    rows = docs.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(run, RESULT_DDL).withColumn("doc_id", real_id("doc_id"))


def op2_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: patterns and the tagger's additions."""
    docs = documents(spark, sf_dir)
    return find(docs, fit(docs))
