"""Generated inputs checked against plain-Python statements of the rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from appraise.functions import uri
from appraise.functions.labels import AUCTION_RULES, TRANSMISSION_GROUPED, label

PATHS = st.lists(st.text(alphabet="ab/.:", max_size=14), min_size=20, max_size=120)
FRAGMENTS = ["AVANZA", " ", "1.3", "1.5", "M/T", "A/T", "MT", "AT", " G", " VELOZ", " E",
             " S", "x", "1500"]
TEXTS = st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=6).map("".join),
                 min_size=20, max_size=120)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_label(text, rules):
    if text is None:
        return None
    for keyword, lab in rules.rules:
        if keyword in text:
            return lab
    return rules.default


@SETTINGS
@given(paths=PATHS)
def test_uri_functions_match_python(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", uri.bucket("p").alias("b"), uri.key("p").alias("k"),
                     uri.base_name("p").alias("n"), uri.first_level("p").alias("f"),
                     uri.after_first_level("p").alias("a"),
                     uri.drop_last_levels("p", 3).alias("d")).collect()
    for r in rows:
        p = r["p"]
        parts = p.split("/")
        assert r["b"] == (parts[2] if len(parts) > 2 else "")
        assert r["k"] == "/".join(parts[3:])
        assert r["n"] == parts[-1]
        assert r["f"] == p.split("/", 1)[0]
        assert r["a"] == (p.split("/", 1)[1] if "/" in p else "")
        assert r["d"] == p.rsplit("/", 3)[0]


@SETTINGS
@given(texts=TEXTS)
def test_labels_match_python(spark, texts):
    rule_sets = list(AUCTION_RULES) + [TRANSMISSION_GROUPED]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    cols = [label("t", rs).alias(f"l{i}") for i, rs in enumerate(rule_sets)]
    for r in df.select("t", *cols).collect():
        for i, rs in enumerate(rule_sets):
            assert r[f"l{i}"] == py_label(r["t"], rs), (r["t"], rs.name)


@SETTINGS
@given(data=st.data())
def test_cut_search_with_ties_matches_sort(spark, data):
    from pyspark.sql import functions as F

    from appraise.operators.split import find_cut
    n = data.draw(st.integers(min_value=1, max_value=300))
    keys = data.draw(st.lists(st.integers(0, 10**6), min_size=n, max_size=n, unique=True))
    # hashes from a tiny range (many ties), spread over both 16-bit halves
    hashes = data.draw(st.lists(st.sampled_from([0, 1, 65536, 65537, 2**31, 2**32 - 1]),
                                min_size=n, max_size=n))
    quota = data.draw(st.integers(min_value=0, max_value=n))
    df = spark.createDataFrame(list(zip(hashes, keys)), "h long, k long")
    cut = find_cut(df, "h", "k", quota)
    got = {r["k"] for r in df.filter(cut.predicate(F.col("h"), F.col("k"))).collect()}
    want = {k for _, k in sorted(zip(hashes, keys))[:quota]}
    assert got == want


@SETTINGS
@given(data=st.data())
def test_latest_per_key_matches_python(spark, data):
    import datetime as dt

    from appraise.operators.latest import latest_per_key
    rows = data.draw(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5),
                                        st.integers(0, 50)), min_size=1, max_size=80,
                              unique_by=lambda r: r[2]))
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, t0 + dt.timedelta(minutes=m), i) for k, m, i in rows],
                               "k string, ts timestamp_ntz, id long")
    got = {r["k"]: r["id"] for r in latest_per_key(df, ["k"], "ts", "id", ["id"]).collect()}
    want = {}
    for k, m, i in rows:
        best = want.get(k)
        if best is None or (m, -i) > (best[0], -best[1]):
            want[k] = (m, i)
    assert got == {k: i for k, (m, i) in want.items()}


@SETTINGS
@given(data=st.data())
def test_zip_join_matches_zip_longest(spark, data):
    from itertools import zip_longest

    from appraise.operators.positional import zip_join
    a = data.draw(st.lists(st.integers(0, 10**6), max_size=60, unique=True))
    b = data.draw(st.lists(st.integers(0, 10**6), min_size=1, max_size=60, unique=True))
    parts = data.draw(st.integers(1, 5))
    left = spark.createDataFrame([(x,) for x in a] or [], "a long").repartition(parts)
    right = spark.createDataFrame([(x,) for x in b], "b long").repartition(parts)
    rows = sorted(zip_join(left, right, ["a"], ["b"]).collect(), key=lambda r: r["pos"])
    assert [(r["a"], r["b"]) for r in rows] == list(zip_longest(sorted(a), sorted(b)))
