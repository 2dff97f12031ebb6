"""The queries of this package over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from macrospark.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    phrases,
    quality,
    sharding,
    substring_dedup,
    token_counts,
    url_filter,
)
from macrospark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest_columns(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest_columns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest_columns(table(spark, sf_dir, "documents"))


ORACLE["op3_line_dedup"] = r"""
with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
counted as (
  select doc_id, lines, list_transform(lines,
    lambda l: len(list_filter(string_split_regex(l, '[ \t\n\x0b\f\r]+'), lambda w: w <> ''))) as words from texts),
starts as (
  select doc_id, lines, words, k, unnest(range(1, len(lines) - k + 2)) as i
  from counted, (select unnest([1, 2, 3]) as k) where k <= len(lines)),
runs as (
  select doc_id, i, k, array_to_string(list_slice(lines, i, i + k - 1), chr(10)) as run
  from starts where k = 3 or list_sum(list_slice(words, i, i + k - 1)) >= 50),
ranked as (select doc_id, i, k, row_number() over (partition by k, run order by doc_id, i) as place from runs),
removed as (
  select distinct doc_id, p, true as gone
  from (select doc_id, unnest(range(i, i + k)) as p from ranked where place > 1)),
placed as (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as p from texts)
select doc_id, count(*) as n_lines, count(gone) as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by p) filter (where gone is null), '')) as kept_sha256
from placed left join removed using (doc_id, p) group by doc_id
"""


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest_columns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op4_decontaminate"] = r"""
with item_words as (
  select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') as w
  from benchmark),
windows as (
  select item, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i, w from item_words
  where len(w) > 0),
patterns as (select distinct item, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as pattern from windows),
lengths as (select distinct m from patterns),
doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') as w
  from documents),
doc_windows as (
  select doc_id, m, unnest(range(1, len(w) - m + 2)) as i, w from doc_words, lengths),
hits as (
  select doc_id, item, i, m from (
    select doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') as pattern from doc_windows)
  join patterns using (m, pattern)),
hit_words as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + m)) as p from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("digest", "text_sha256")


ORACLE["op5_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest_columns(table(spark, sf_dir, "documents"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest_columns(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest_columns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest_columns(table(spark, sf_dir, "documents"))


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest_columns(table(spark, sf_dir, "documents"))


ORACLE["op10_licenses"] = licenses.oracle_sql()


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest_columns(table(spark, sf_dir, "documents"))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents"))


ORACLE["op12_phrases"] = phrases.ORACLE


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest_columns(table(spark, sf_dir, "embeddings"))


ORACLE["op13_hard_negatives"] = hard_negatives.ORACLE
