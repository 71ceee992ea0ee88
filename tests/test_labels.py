from appraise.functions.labels import (AUCTION_RULES, TRANSMISSION, TRANSMISSION_GROUPED,
                                       label, with_labels)

# Cases from FIXTURES §1: (Type, transmisi, type_detail, cc)
CASES = [
    ("AVANZA 1.3 G M/T", "manual", "G", "1.3"),
    ("AVANZA VELOZ 1.5 A/T", "automatic", "VELOZ", "1.5"),
    ("AVANZA 1.5 S AT", "automatic", "S", "1.5"),
    ("AVANZA 1.3 E MT A/T", "automatic", "E", "1.3"),
    ("AVANZA 1500 S M/T", "manual", "S", "1.3"),
    ("avanza x", "manual", "E", "1.3"),
    (None, None, None, None),
]


def test_rule_labels(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "Type string")
    got = {r["Type"]: (r["transmisi"], r["type_detail"], r["cc"])
           for r in with_labels(df, "Type", AUCTION_RULES).collect()}
    for t, tr, td, cc in CASES:
        assert got[t] == (tr, td, cc), t


def test_grouped_precedence_differs_only_on_mixed_text(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "Type string")
    rows = df.select("Type", label("Type", TRANSMISSION).alias("a"),
                     label("Type", TRANSMISSION_GROUPED).alias("b")).collect()
    diff = {r["Type"] for r in rows if r["a"] != r["b"]}
    assert diff == {"AVANZA 1.3 E MT A/T"}


def test_label_plan_has_no_python(spark):
    df = spark.createDataFrame([("AVANZA 1.3 G M/T",)], "Type string")
    plan = with_labels(df, "Type")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
