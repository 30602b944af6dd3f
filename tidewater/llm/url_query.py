"""The URL filter's query: captures and dated lists derived from pages, and its SQL.

The pages table has neither fetch days nor lists, so both come from its own values: a page is fetched on day
page_id mod 366 of 2024; entries, their days and their actions follow from the md5 of each host and section seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.url_filter import temporal_filter, with_keys


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(pmod(page_id, 366) as int))").alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Up to four dated entries for about two fifths of all hosts, host sections and parent domains."""
    seen = with_keys(pages.select("url")).where("host is not null")
    values = seen.select(F.explode(F.array(
        F.col("host"), F.expr("concat_ws('/', host, lower(section))"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1))).alias(
        "value")).where("value <> ''").distinct()
    number = lambda start: f"cast(conv(substring(md5(value), {start}, 4), 16, 10) as int)"
    drawn = values.selectExpr("value", f"{number(1)} as a", f"{number(5)} as b", f"{number(9)} as c").where("a % 5 < 2")
    drawn = drawn.selectExpr("value", "b", "c", "if(a % 5 = 0, 'block', if(b % 4 = 0, 'allow', 'spam')) as list")
    return drawn.selectExpr("value", """stack(4,
        list, date_add(date'2024-01-01', b % 300), 'add',
        list, date_add(date'2024-01-01', b % 300 + 1 + c % 60), 'remove',
        list, date_add(date'2024-01-01', b % 300 + 70 + c % 90), 'add',
        if(c % 7 = 0, 'allow', 'block'), date_add(date'2024-01-01', c % 366), 'add') as (list, day, action)""")


def captures_filtered(pages: DataFrame) -> DataFrame:
    return temporal_filter(captures_of(pages), entries_of(pages))


SQL = r"""
WITH keyed AS (
  SELECT page_id, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
         nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1), '') AS section
  FROM pages),
vals AS (
  SELECT DISTINCT value FROM (
    SELECT host AS value FROM keyed
    UNION ALL SELECT CASE WHEN section IS NULL THEN host ELSE host || '/' || lower(section) END FROM keyed
    UNION ALL SELECT regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) FROM keyed)
  WHERE value <> ''),
drawn AS (
  SELECT * FROM (
    SELECT value, CAST('0x' || substr(md5(value), 1, 4) AS INTEGER) AS a, CAST('0x' || substr(md5(value), 5, 4) AS INTEGER) AS b,
           CAST('0x' || substr(md5(value), 9, 4) AS INTEGER) AS c FROM vals) WHERE a % 5 < 2),
lists AS (SELECT *, CASE WHEN a % 5 = 0 THEN 'block' WHEN b % 4 = 0 THEN 'allow' ELSE 'spam' END AS l FROM drawn),
entries AS (
  SELECT l AS list, value, DATE '2024-01-01' + b % 300 AS day, 'add' AS action FROM lists
  UNION ALL SELECT l, value, DATE '2024-01-01' + (b % 300 + 1 + c % 60), 'remove' FROM lists
  UNION ALL SELECT l, value, DATE '2024-01-01' + (b % 300 + 70 + c % 90), 'add' FROM lists
  UNION ALL SELECT CASE WHEN c % 7 = 0 THEN 'allow' ELSE 'block' END, value, DATE '2024-01-01' + c % 366, 'add' FROM lists),
daily AS (SELECT list, value, day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (
  SELECT * FROM (SELECT list, value, day AS valid_from, lead(day) OVER (PARTITION BY list, value ORDER BY day) AS valid_to, action
                 FROM daily) WHERE action = 'add'),
active AS (
  SELECT k.page_id, s.*, row_number() OVER (PARTITION BY k.page_id ORDER BY length(s.value) DESC, (s.list = 'allow') DESC,
         s.list DESC, s.value DESC) AS place, count(*) OVER (PARTITION BY k.page_id) AS n
  FROM keyed k JOIN spans s ON (k.host = s.value OR ends_with(k.host, '.' || s.value) OR k.host || '/' || lower(k.section) = s.value)
       AND s.valid_from <= k.day AND (s.valid_to IS NULL OR k.day < s.valid_to))
SELECT k.page_id, k.host, CAST(k.day AS DATE) AS fetched_on, coalesce(t.n, 0) AS n_active, coalesce(t.list <> 'allow', FALSE) AS blocked,
       t.list, t.value AS entry, CAST(t.valid_from AS DATE) AS valid_from, CAST(t.valid_to AS DATE) AS valid_to
FROM keyed k LEFT JOIN active t ON t.page_id = k.page_id AND t.place = 1
"""
