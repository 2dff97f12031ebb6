"""Queries of the landed documents, the normalisers and the archive."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from macrospark.catalog.base import (
    BEA, BEA_KEYS, BLS, BLS_IDS, FRED, FRED_IDS, bea_raw, bls_raw, fred_raw, pick, query, sql_pick, table,
)
from macrospark.functions import scalars as S
from macrospark.plans import normalize
from macrospark.session import new_run_dir
from macrospark.sources import dims, json_docs, sinks

DAY = datetime.date(2024, 1, 31)


def _land(spark, docs, source):
    """Archive documents in a folder of this run and give the folder."""
    return sinks.archive_json(spark, docs, new_run_dir(spark, f"landing-{source}"), source, DAY)


@query(f"""
WITH docs AS (SELECT *, {sql_pick(FRED_IDS, 'o_custkey')} AS series_id, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT series_id, day AS observation_date, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS value
FROM docs WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT series_id, day + 30, NULL FROM docs WHERE o_orderpriority <> '5-LOW'""")
def json_flatten_observations(spark, sf):
    """A document per order with two observations; low-priority ones lack the array."""
    price = F.when(F.col("o_orderstatus") == "P", ".").otherwise(F.col("o_totalprice").cast("string"))
    day = F.col("o_orderdate").cast("date")
    payload = F.when(
        F.col("o_orderpriority") == "5-LOW", F.format_string('{"id":%d,"message":"none"}', "o_orderkey")
    ).otherwise(
        F.format_string(
            '{"id":%d,"observations":[{"date":"%s","value":"%s"},{"date":"%s","value":"."}]}',
            F.col("o_orderkey"), day.cast("string"), price, F.date_add(day, 30).cast("string"),
        )
    )
    docs = table(spark, sf, "orders").select(F.lower(pick(FRED_IDS, F.col("o_custkey"))).alias("indicator"), payload.alias("payload"))
    records, _ = json_docs.read_fred_json(spark, _land(spark, docs, "fred"))
    return records.select(
        "series_id",
        S.normalize_date("date").alias("observation_date"),
        S.safe_double(S.missing_to_null("value", S.FRED_MISSING)).alias("value"),
    )


@query(f"""
WITH docs AS (SELECT *, {sql_pick(BEA_KEYS, 'o_custkey')} AS table_key FROM orders)
SELECT table_key, CASE WHEN o_orderstatus <> 'P' THEN 'record' WHEN o_orderpriority = '1-URGENT' THEN 'unreadable document'
                       ELSE '{{"APIErrorCode":"40"}}' END AS outcome,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%YM%m') END AS period,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value
FROM docs""")
def json_error_quarantine(spark, sf):
    """A document per order; pending ones report an error, urgent pending ones are cut off."""
    good = F.format_string(
        '{"id":%d,"BEAAPI":{"Results":{"Data":[{"LineNumber":"1","TimePeriod":"%s","DataValue":"%s"}]}}}',
        F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy'M'MM"), F.format_number("o_totalprice", 2),
    )
    pending = F.col("o_orderstatus") == "P"
    payload = (
        F.when(pending & (F.col("o_orderpriority") == "1-URGENT"), F.format_string('{"id":%d,"BEAAPI":{"Resul', "o_orderkey"))
        .when(pending, F.format_string('{"id":%d,"BEAAPI":{"Results":{"Error":{"APIErrorCode":"40"}}}}', "o_orderkey"))
        .otherwise(good)
    )
    docs = table(spark, sf, "orders").select(pick(BEA_KEYS, F.col("o_custkey")).alias("indicator"), payload.alias("payload"))
    records, quarantine = json_docs.read_bea_json(spark, _land(spark, docs, "bea"))
    rows = records.select(
        "table_key", F.lit("record").alias("outcome"), F.col("TimePeriod").alias("period"), S.parse_thousands("DataValue").alias("value")
    )
    failed = quarantine.select(F.col("indicator").alias("table_key"), F.col("error").alias("outcome"))
    return rows.unionByName(failed, allowMissingColumns=True)


@query(f"""
WITH docs AS (SELECT *, {sql_pick(BLS_IDS, 'o_custkey')} AS series_id FROM orders WHERE o_orderstatus <> 'P'),
points AS (SELECT o_orderkey, series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date, o_totalprice AS value FROM docs
  UNION ALL SELECT o_orderkey, series_id, CAST(date_trunc('quarter', o_orderdate) AS DATE), NULL FROM docs
  UNION ALL SELECT o_orderkey, 'X' || o_orderpriority, CAST(date_trunc('year', o_orderdate) AS DATE), o_totalprice FROM docs)
SELECT series_id, observation_date, value, CASE WHEN value IS NULL THEN 'P,R' END AS footnote_codes FROM points""")
def json_two_level_explode(spark, sf):
    """A document per order with two series, the first of two points; pending requests failed."""
    year = F.date_format("o_orderdate", "yyyy")
    price = F.col("o_totalprice").cast("string")
    good = F.format_string(
        '{"id":%d,"status":"REQUEST_SUCCEEDED","message":[],"Results":{"series":['
        '{"seriesID":"%s","data":[{"year":"%s","period":"M%s","value":"%s","footnotes":[{}]},'
        '{"year":"%s","period":"Q0%d","value":"-","footnotes":[{"code":"P"},{},{"code":"R"}]}]},'
        '{"seriesID":"X%s","data":[{"year":"%s","period":"A01","value":"%s","footnotes":[]}]}]}}',
        F.col("o_orderkey"), pick(BLS_IDS, F.col("o_custkey")), year, F.date_format("o_orderdate", "MM"), price,
        year, F.quarter("o_orderdate"), F.col("o_orderpriority"), year, price,
    )
    failed = F.format_string('{"id":%d,"status":"REQUEST_NOT_PROCESSED","message":["daily limit"]}', "o_orderkey")
    payload = F.when(F.col("o_orderstatus") == "P", failed).otherwise(good)
    docs = table(spark, sf, "orders").select(F.lit("bulk").alias("indicator"), payload.alias("payload"))
    records, _ = json_docs.read_bls_json(spark, _land(spark, docs, "bls"))
    return records.select(
        "series_id",
        S.parse_period_coded("year", "period").alias("observation_date"),
        S.safe_double(S.missing_to_null("value", S.BLS_MISSING)).alias("value"),
        S.join_codes("footnotes").alias("footnote_codes"),
    )


_FRED_DIM = ", ".join(f"('{i}', '{c}', '{u}', '{f}')" for i, _, c, u, f in dims.rows_of(dims.FRED_SERIES))


@query(f"""
WITH {FRED}, dim(series_id, category, units, frequency) AS (VALUES {_FRED_DIM})
SELECT f.series_id, observation_date, value, value IS NULL AS value_is_missing, coalesce(category, 'unknown') AS category,
       coalesce(units, '') AS units, coalesce(frequency, '') AS frequency, 'fred' AS source,
       'https://fred.stlouisfed.org/series/' || f.series_id AS series_url, '1.0.0' AS pipeline_version
FROM fred f LEFT JOIN dim USING (series_id)""")
def normalize_observations(spark, sf):
    rows, _ = normalize.normalize_fred(fred_raw(spark, sf), dims.fred_series_dim(spark), F.col("ingested_at"))
    return rows.drop("ingested_at", "description")


@query(f"""
WITH {BEA} SELECT table_key, series_name, period_date, value, value IS NULL AS is_missing, bea_table_name,
  bea_line_number, 'Line ' || bea_line_number AS bea_line_description, frequency, 'Level' AS units
FROM bea WHERE period_date IS NOT NULL""")
def line_map_filter(spark, sf):
    rows, _ = normalize.normalize_bea(bea_raw(spark, sf), dims.bea_line_dim(spark), F.col("ingested_at"))
    return rows.drop("ingested_at", "description", "source", "pipeline_version", "bea_period_str")


@query(f"WITH {BEA} SELECT table_key, CAST(bea_line_number AS VARCHAR) AS line, 'n/a' AS period, l_orderkey FROM bea WHERE period_date IS NULL")
def reject_rows(spark, sf):
    _, bad = normalize.normalize_bea(bea_raw(spark, sf), dims.bea_line_dim(spark), F.col("ingested_at"))
    return bad.select("table_key", F.col("LineNumber").alias("line"), F.col("TimePeriod").alias("period"), "l_orderkey")


_BLS_DIM = ", ".join(f"('{i}', '{c}', '{f}', '{s}')" for i, _, c, _, f, s in dims.rows_of(dims.BLS_SERIES))


@query(f"""
WITH {BLS}, dim(series_id, category, frequency, survey) AS (VALUES {_BLS_DIM})
SELECT b.series_id, observation_date, value, value IS NULL AS is_missing, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN quarterly THEN 'Q0' || quarter(o_orderdate) ELSE strftime(o_orderdate, 'M%m') END AS period,
       monthname(o_orderdate) AS period_name,
       CASE o_orderstatus WHEN 'P' THEN 'P,R' WHEN 'O' THEN 'R' END AS footnote_codes,
       coalesce(category, 'unknown') AS category, coalesce(frequency, 'monthly') AS frequency,
       coalesce(survey, '') AS survey, CASE WHEN category IS NULL THEN '' ELSE 'seasonally_adjusted' END AS seasonal_adjustment
FROM bls b LEFT JOIN dim USING (series_id)""")
def normalize_codes(spark, sf):
    rows, _ = normalize.normalize_bls(bls_raw(spark, sf), dims.bls_series_dim(spark), F.col("ingested_at"))
    return rows.drop("ingested_at", "description", "units", "source", "series_url", "pipeline_version")


@query("""
SELECT o_orderpriority AS indicator, payload, substr(md5(payload), 1, 8) AS content_hash
FROM (SELECT DISTINCT o_orderpriority, '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS payload FROM orders)
WHERE (o_orderpriority, payload) NOT IN
  (SELECT o_orderpriority, '{"o_custkey":' || o_custkey || ',"o_orderstatus":"F"}' FROM orders WHERE o_orderstatus = 'F')""")
def content_hash_dedupe(spark, sf):
    """Documents not yet archived, when the final orders' ones are and everything is sent twice."""
    orders = table(spark, sf, "orders")
    docs = orders.select(F.col("o_orderpriority").alias("indicator"), F.to_json(F.struct("o_custkey", "o_orderstatus")).alias("payload"))
    archived = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("indicator"), F.to_json(F.struct("o_custkey", "o_orderstatus")).alias("payload")
    )
    return sinks.new_documents(docs.unionAll(docs), archived)
