"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import pytest
from pyspark.sql import types as T

from appraise.llm import (doubling_dedup, exact_dedup, language_model, mixing, packing, personal_data,
                          quality, simhash, suffix_dedup, url_filter)
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30000))
ROWS = [
    (1, "a plain short text with a mail a.b@c.org and some more words in it", "s1"),
    (2, "a plain short text with a mail a.b@c.org and some more words in it", "s2"),
    (2, "a plain short text with a mail a.b@c.org and some more words in it", "s2"),   # repeated row
    (3, None, "s1"), (4, "", None), (5, " \t\n ", "s1"), (None, "text without an id", "s2"),
    (6, LONG, "s1"), (7, "x" * 5000, None), (8, "ünï çödé " * 30, "s2"), (9, None, None),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("source", T.StringType())])
CLASH = ["_id", "_th", "_text", "_doc", "_h", "_b", "size", "fp", "word", "c", "g", "keep", "digest",
         "_n_words", "_rn", "host", "path", "vertex", "_members", "_nth", "taken", "_key"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASH:
        df = df.withColumn(name, F.lit("other"))
    return df


OPERATORS = {
    "packing": lambda d: packing.pack(d, ranges=2),
    "personal_data": lambda d: personal_data.find(d, personal_data.train([], steps=1)),
    "suffix": suffix_dedup.removed_bytes,
    "language_model": language_model.scores,
    "quality": lambda d: quality.judge(d).drop("_doc"),
    "keep_good": quality.keep_good,
    "mixing": lambda d: mixing.mix(d, F.array("source"))[0],
    "mixed": mixing.mixed_documents,
    "doubling": doubling_dedup.removed_words,
    "simhash": simhash.near_groups,
    "near": simhash.drop_near_copies,
    "exact": exact_dedup.exact_groups,
    "exact_kept": exact_dedup.drop_copies,
}
PER_ROW = ["personal_data", "suffix", "language_model", "quality", "mixing", "doubling", "simhash", "exact"]


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    out = OPERATORS[name](frame(spark, ROWS)).collect()
    assert out
    if name in PER_ROW:
        assert len(out) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


def test_exact_kept_one_of_repeated_rows(spark):
    kept = exact_dedup.drop_copies(frame(spark, ROWS)).select("doc_id", "_id").collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [
        (False, 1), (False, 5), (False, 6), (False, 7), (False, 8), (True, None)]
    assert {r._id for r in kept} == {"other"}
    groups = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, ROWS)).collect()}
    assert groups[1].group_size == 3 and groups[3].keep_id == 5 and groups[3].group_size == 4


def test_near_keeps_smallest_id(spark):
    kept = {r.doc_id for r in simhash.drop_near_copies(frame(spark, ROWS)).collect()}
    assert 1 in kept and 2 not in kept and 3 in kept and not kept & {4, 5, 9}


def test_quality_defined_results(spark):
    out = {r._doc.doc_id: r for r in quality.judge(frame(spark, ROWS)).select(
        "_doc", "_n_words", "_rejected_by", "_base_failed").collect()}
    assert out[3]._n_words == 0 and out[3]._base_failed and out[1]._rejected_by is None
    assert out[7]._base_failed


def test_url_edges(spark):
    pages = [(1, None, None), (2, "no scheme", "<html>"), (3, "", None), (4, "http://", "x"),
             (5, "HTTP://A.Example.ORG/en/12?q#f", "<b>"), (5, "HTTP://A.Example.ORG/en/12?q#f", "<b>"),
             (6, "ftp://x.com?p", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("_node", F.lit(1)) \
        .withColumn("host", F.lit("h")).withColumn("_rule", F.lit(2))
    out = sorted(map(tuple, url_filter.judge_urls(df, url_filter.RULES).drop("alias_group").collect()))
    assert out == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
                   (4, "", "", None, "allow"), (5, "a.example.org", "/en/12", "example.org/en/1", "block"),
                   (5, "a.example.org", "/en/12", "example.org/en/1", "block"), (6, "x.com", "", None, "allow")]
    assert url_filter.judge_urls(df.limit(0), url_filter.RULES).collect() == []


SAME = [n for n in OPERATORS if n not in ("packing", "language_model")]


@pytest.mark.parametrize("name", SAME)
def test_other_columns_change_nothing(spark, name):
    """Clashing names beside the table's own columns leave every value as it is."""
    plain = OPERATORS[name](spark.createDataFrame(ROWS, SCHEMA).repartition(3))
    clash = OPERATORS[name](frame(spark, ROWS)).select(*plain.columns)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, clash.collect()))


def test_values_of_edge_rows(spark):
    """Null, empty and blank texts count as empty; a repeated row is treated like the row it repeats."""
    df = frame(spark, ROWS)
    groups = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_groups(df).collect()}
    empty = [r for r in groups.values() if r.group_size == 4]
    assert {r.doc_id for r in empty} == {3, 4, 5, 9} and {r.keep_id for r in empty} == {5}
    assert {r.group_size for r in groups.values() if r.doc_id in (1, 2)} == {3}
    judged = {(r["_doc"]["doc_id"], r["_doc"]["text"]): r for r in quality.judge(df).collect()}
    assert all(judged[k]["_n_words"] == 0 and judged[k]["_base_failed"] for k in ((3, None), (4, ""), (5, " \t\n "), (9, None)))
    assert judged[(6, LONG)]["_n_words"] == 30000
    cut = {r._id: r for r in suffix_dedup.removed_bytes(df).collect()}
    assert (cut[3].n, cut[3].removed, cut[7].removed) == (0, 0, 5000)
    words = doubling_dedup.removed_words(df).where("_id = 2").collect()
    assert len(words) == 2 and len({tuple(w) for w in words}) == 1
    prints = {r._id: r for r in simhash.near_groups(df).collect()}
    assert prints[3].fp == prints[4].fp == prints[5].fp == 0 and prints[1].fp == prints[2].fp
    found = {r.doc_id: r for r in personal_data.find(df, personal_data.train([], steps=1)).collect()}
    assert found[1].n_email == found[2].n_email == 1 and found[3].spans == found[4].spans == ""
    taken = {(r["_id"], r["size"]) for r in mixing.mix(df, F.array("source"))[0].collect()}
    assert (3, 0) in taken and (6, 30000) in taken
