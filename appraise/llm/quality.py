"""Quality rules as a short-circuit cascade, DataFrame functions only.

Rules are conditions that reject a document. On a sample each rule's rejection
rate is counted and its cost measured (seconds the rule alone takes over the
kept sample, less those of a job without a rule); the cascade then asks the rules in order of rejection per cost
and stops at the first that rejects. The order changes the time, never the
verdict. Everything is a projection: no shuffle, no Python.

Null text: no words. A text without words fails ``few_words``. Ids play no part, so null
ones are judged like others; long texts are measured whole; rules of equal rejection per
cost keep their listed order. Repeated rows are judged alike; an empty table gives an empty result (the sample is then empty and
rules keep their listed order). Inner columns are prefixed and the document's
own columns are carried in one struct, so clashing names are safe.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from appraise.llm.common import SPACES, WORD, documents, text_of

SAMPLE_FRACTION = 0.01      # share of the rows the costs and selectivities are measured on,
SAMPLE_ROWS = 100_000       # and about how many they are at most
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
REPEAT_WINDOW = 5


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the optimizer copies around."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACES + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def line_counts(text: Column) -> Column:
    """Struct (n, dup): lines with a word, and those equal to an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))


def n_repeat_words(text: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text.

    Windows are hashed; only a text with a repeated hash sorts its (hash, place)
    pairs, and neighbours with equal hashes must also have equal words. The
    covered words are summed over the sorted places, each up to the next one.
    """
    n = REPEAT_WINDOW
    words = F.filter(F.split(text, SPACES + "+"), lambda w: w != "")

    def of_words(w):
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))

        def window(x):
            return F.slice(w, x["at"] + 1, n)

        def same(x, y):
            return F.coalesce((x["h"] == y["h"]) & (window(x) == window(y)), F.lit(False))

        def of_pairs(p):
            twice = F.filter(p, lambda x, i: same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1)))
            return let(F.array_sort(F.transform(twice, lambda x: x["at"])), lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(n)), F.lit(n))),
                F.lit(0).cast("long"), lambda acc, x: acc + x))

        def of_hashes(h):
            return F.when(F.size(F.array_distinct(h)) < F.size(h), let(F.array_sort(F.transform(
                h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))), of_pairs)).otherwise(F.lit(0).cast("long"))

        return F.when(F.size(w) > n, let(hashes, of_hashes)).otherwise(F.lit(0).cast("long"))

    return let(words, of_words)


# Rules: name -> condition that rejects, over the measure columns below.
RULES: dict[str, str] = {
    "few_words": f"_n_words < {MIN_WORDS}",
    "long_words": "_chars > 25 * _n_words",
    "short_words": "_chars < 2 * _n_words",
    "symbols": "3 * _symbols > _n_words",
    "dup_lines": "2 * _lines.dup > _lines.n",
    "repeats": "100 * _repeat > 20 * _n_words",
}
BASE = ("few_words", "repeats")
NEEDS = {"few_words": ("words",), "long_words": ("words", "chars"),
         "short_words": ("words", "chars"), "symbols": ("words", "symbols"),
         "dup_lines": ("lines",), "repeats": ("words", "repeat")}


MEASURES = {"words": ("_n_words", n_words), "chars": ("_chars", word_chars),
            "symbols": ("_symbols", n_symbols), "lines": ("_lines", line_counts),
            "repeat": ("_repeat", n_repeat_words)}


def _measured(df: DataFrame, needs: tuple[str, ...]) -> DataFrame:
    """Add the measure columns over ``_text`` that ``needs`` names."""
    for name in needs:
        column, of = MEASURES[name]
        df = df.withColumn(column, of(F.col("_text")))
    return df


def _kept_where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter above the measures: the row number beside them keeps the optimizer
    from moving the filter below, where every use would compute them again."""
    return df.withColumn("_nth", F.monotonically_increasing_id()).where(
        condition & (F.col("_nth") >= 0)).drop("_nth")


def rule_order(docs: DataFrame, text_col: str = "text", fraction: float = SAMPLE_FRACTION) -> list[str]:
    """Rule names by measured rejection per cost, best first."""
    share = min(fraction, SAMPLE_ROWS / max(1, docs.count()))
    sample = docs.select(text_of(text_col).alias("_text")).sample(share, seed=17).persist()
    try:
        n = sample.count()
        rate: dict[str, float] = {}
        if n:
            t0 = time.perf_counter()
            _kept_where(sample, F.lit(True)).count()
            idle = time.perf_counter() - t0                 # what a job costs that asks nothing
            for name, condition in RULES.items():
                t0 = time.perf_counter()
                bad = _kept_where(_measured(sample, NEEDS[name]), F.expr(condition)).count()
                rate[name] = (bad / n) / max(time.perf_counter() - t0 - idle, 1e-4)
        return sorted(RULES, key=lambda r: (-rate.get(r, 0.0), list(RULES).index(r)))
    finally:
        sample.unpersist()


def _verdict(order: list[str]) -> Column:
    """First rule that rejects, null if none does: CASE stops at the first hit."""
    out = None
    for name in order:
        hit = F.expr(RULES[name])
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def judge(docs: DataFrame, text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """``docs`` in struct ``_doc`` with every measure, ``_base_failed`` and ``_rejected_by``."""
    order = order or rule_order(docs, text_col)
    df = docs.select(F.struct("*").alias("_doc"), text_of(text_col).alias("_text"))
    df = _measured(df, tuple(MEASURES)).drop("_text")
    base = F.expr(" OR ".join(f"({RULES[r]})" for r in BASE))
    return df.withColumn("_base_failed", base).withColumn("_rejected_by", _verdict(order))


def keep_good(docs: DataFrame, text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """The documents no rule rejects: one filter per rule, in cascade order.

    A measure is computed just before the first rule that needs it, so a
    document an earlier rule rejects never pays for a later measure.
    """
    order = order or rule_order(docs, text_col)
    names = docs.columns
    df, have = docs.select(F.struct("*").alias("_doc"), text_of(text_col).alias("_text")), set()
    for name in order:
        df = _measured(df, tuple(x for x in NEEDS[name] if x not in have))
        have |= set(NEEDS[name])
        df = _kept_where(df, ~F.expr(RULES[name]))
    return df.select(*[F.col("_doc").getField(n).alias(n) for n in names])


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and the cascade's verdict for every document."""
    out = judge(documents(spark, sf_dir))
    return out.select(
        F.col("_doc.doc_id").alias("doc_id"), F.col("_n_words").alias("n_words"),
        F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_lines.dup").alias("n_dup_lines"), F.col("_repeat").alias("n_repeat_words"),
        F.col("_base_failed").alias("base_failed"), F.col("_rejected_by").isNull().alias("kept"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 5)),
dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win)
  WHERE c > 1),
rep AS (
  SELECT doc_id, sum(least(5, coalesce(nx - i, 5)))::BIGINT AS r
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM dup)
  GROUP BY doc_id),
ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(ln.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(ln.n_lines, 0) AS n_lines,
         coalesce(rep.r, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR word_chars > 25 * n_words
            OR word_chars < 2 * n_words OR 3 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""
