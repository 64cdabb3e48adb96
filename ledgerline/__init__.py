"""ledgerline: a Spark-native payments lakehouse.

Raw customers, merchants, payments, chargebacks, FX rates, account events and a
denylist are landed as bronze Parquet, cleaned and joined into silver, and
modelled into a gold star schema with daily KPI and cohort marts. Business
reports, data-quality suites and the event stream landing all run as plain
DataFrame / Structured Streaming jobs.

Layout
------
sources/    raw readers, lake layout (bronze/silver/gold paths), testdata mapping
functions/  column expressions shared by operators (dates, money, ratios)
operators/  DataFrame -> DataFrame steps: clean, enrich, events, gold, reports, quality
plans/      composite jobs (bronze ingest, silver and gold refresh) and the query catalog
streaming/  Structured Streaming landing of the event topic
"""

