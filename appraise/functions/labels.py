"""Label a free-text column by ordered keyword rules.

A rule set is an ordered list of ``(keyword, label)`` pairs plus a default.
The first keyword contained in the text decides the label; the default is used
only when no keyword hits; a NULL text gives a NULL label. The whole rule set
becomes one ``CASE WHEN`` expression, so it stays inside whole-stage codegen
and needs no Python at run time. A dictionary too large for an expression is a table
of ranked rules instead (``label_by_table``): each keyword is anchored at its rarest
gram, texts meet rules by equal grams, the pair is verified by ``contains``, and
the lowest rank is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[tuple[str, str], ...]
    default: str

    @classmethod
    def from_groups(cls, name: str, groups: Sequence[tuple[str, Sequence[str]]],
                    default: str) -> RuleSet:
        """Build from ``[(label, [keywords...]), ...]``, label by label."""
        return cls(name, tuple((k, label) for label, kws in groups for k in kws), default)


# Keyword rules of the auction labelling, in their original order.
# transmission: "M/T" -> manual, "A/T" -> automatic, "MT" -> manual, "AT" -> automatic, else manual
# trim:         " G" -> G, " VELOZ" -> VELOZ, " E" -> E, " S" -> S, else E
# engine size:  "1.3" -> 1.3, "1.5" -> 1.5, else 1.3
TRANSMISSION = RuleSet("transmisi", (("M/T", "manual"), ("A/T", "automatic"),
                                     ("MT", "manual"), ("AT", "automatic")), "manual")
TRIM = RuleSet("type_detail", ((" G", "G"), (" VELOZ", "VELOZ"), (" E", "E"),
                               (" S", "S")), "E")
ENGINE_CC = RuleSet("cc", (("1.3", "1.3"), ("1.5", "1.5")), "1.3")

# The later grouped form lists every manual keyword before any automatic one,
# which changes the answer for texts holding both "A/T" and "MT".
TRANSMISSION_GROUPED = RuleSet.from_groups(
    "transmisi", [("manual", ["M/T", "MT"]), ("automatic", ["A/T", "AT"])], "manual")

AUCTION_RULES = (TRANSMISSION, TRIM, ENGINE_CC)


def label(text: Column | str, rules: RuleSet) -> Column:
    """First matching keyword's label, else the default; NULL stays NULL."""
    c = F.col(text) if isinstance(text, str) else text
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for keyword, lab in rules.rules:
        expr = expr.when(c.contains(keyword), F.lit(lab))
    return expr.otherwise(F.lit(rules.default))


def with_labels(df, text_col: str, rule_sets: Sequence[RuleSet] = AUCTION_RULES):
    """Add one label column per rule set (named after the rule set)."""
    return df.withColumns({rs.name: label(text_col, rs) for rs in rule_sets})


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct pieces of ``size`` characters."""
    n = F.length(text)
    return F.when(n >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, F.lit(size)))))


def anchors(rules: DataFrame) -> DataFrame:
    """``rank, keyword, label, gram``: each non-empty keyword's gram that fewest keywords hold (ties: the smallest)."""
    size = F.least(F.length("keyword"), F.lit(GRAM))
    gram = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("keyword") - size + 1),
                                        lambda i: F.substring("keyword", i, size)))
    each = rules.filter("keyword <> ''").select("rank", "keyword", "label", F.explode(gram).alias("gram"))
    held = each.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    best = F.min(F.struct("held", "gram")).alias("best")
    return each.join(held, "gram").groupBy("rank", "keyword", "label").agg(best) \
        .select("rank", "keyword", "label", F.col("best.gram").alias("gram"))


def label_by_table(df: DataFrame, text_col: str, rules: DataFrame, default: str, name: str) -> DataFrame:
    """``df`` with the label of the lowest-ranked keyword its text holds, else the default; NULL stays NULL.

    ``rules``: ``rank, keyword, label``, unique ranks; an empty keyword is held by every
    text. Each distinct text is labelled once. Neither the plan nor the driver grows with the rules.
    """
    texts = df.select(F.col(text_col).alias("__t")).filter(F.col("__t").isNotNull()).distinct()
    pieces = texts.withColumn("gram", F.explode(F.array_distinct(F.flatten(F.array(*[
        F.coalesce(_grams(F.col("__t"), k), F.array().cast("array<string>")) for k in range(1, GRAM + 1)])))))
    hits = pieces.join(anchors(rules), "gram").filter(F.contains("__t", "keyword")) \
        .groupBy("__t").agg(F.min(F.struct("rank", "label")).alias("hit"))
    always = rules.filter("keyword = ''").agg(F.min(F.struct("rank", "label")).alias("always"))
    row = always.first()["always"]                  # one row
    best = F.col("hit")
    if row is not None:
        best = F.least(F.coalesce(best, F.struct(F.lit(row["rank"]).alias("rank"), F.lit(row["label"]).alias("label"))),
                       F.struct(F.lit(row["rank"]).alias("rank"), F.lit(row["label"]).alias("label")))
    found = df.join(hits, F.col(text_col) == F.col("__t"), "left")
    return found.withColumn(name, F.when(F.col(text_col).isNotNull(), F.coalesce(best["label"], F.lit(default)))).drop("__t", "hit")


def rules_frame(spark, rules: RuleSet) -> DataFrame:
    """A rule set as the table that ``label_by_table`` takes."""
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rules.rules)], "rank long, keyword string, label string")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def label_sql(text_sql: str, rules: RuleSet) -> str:
    """The same rule set as an ANSI ``CASE`` (used for the DuckDB oracle)."""
    parts = [f"CASE WHEN ({text_sql}) IS NULL THEN NULL"]
    for keyword, lab in rules.rules:
        parts.append(f"WHEN contains({text_sql}, {_sql_str(keyword)}) THEN {_sql_str(lab)}")
    parts.append(f"ELSE {_sql_str(rules.default)} END")
    return " ".join(parts)
