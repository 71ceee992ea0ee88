import duckdb
import pytest

import __spark_entry__ as E
from appraise.sources.tables import TABLES, table_path
from conftest import SMALL

FAST = ["appraisal_report", "label_keywords", "split_exact", "eval_report", "uri_prefix",
        "latest_by_key", "latest_with_fallback", "best_params", "route_paths", "page_links",
        "jsonld_misses", "jsonld_prices", "page_lookup", "zip_join", "hook_price_join",
        "notify_messages", "paths_joined", "label_branches", "prefix_levels", "miss_reasons",
        "crawl_mean_price", "split_exact_repeated", "stream_training_requests",
        "stream_scoring_requests", "csv_text_roundtrip", "latest_file", "newest_job_params",
        "day_token_utc", "column_slice"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"split", "type_detail", "transmisi", "rmse", "residual_std"} <= set(df.columns)


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    sdf = E.queries()[name](spark, SMALL)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(sdf.columns)
    want = sorted(tuple(_norm(v) for v in r) for r in cur.fetchall())
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    assert got == want
