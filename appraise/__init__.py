"""appraise: price appraisal of listed items as Spark DataFrame jobs.

Subpackages:
    sources    parquet tables, CSV / XLSX / landed pages, registries, sinks
    functions  column expressions: keyword labels, URI arithmetic, text, markup
    operators  splits, metrics, newest/best per key, routing, page lookup,
               zip join, preparation hooks, column layout, GBT model, tuning
    plans      named queries over the landed tables and end-to-end runs
    streaming  notification streams, routing, exactly-once sink

Start a session with ``appraise.session.get_spark``; the named queries are in
``appraise.plans.catalog.all_queries()``.
"""
