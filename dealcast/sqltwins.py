"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, over the same parquet tables. Shared
pieces are CTE fragments; each query is ``WITH <fragments> SELECT ...``.
Fixed rule tables (holidays, word lists) are rendered from the same constants
the library uses, so both sides agree on the values but not on the logic.
"""

from __future__ import annotations

from dealcast.functions.text import AD_WORDS, BOGO_WORDS, GWP_WORDS
from dealcast.operators.holidays import FEDERAL_RULES, PARENT_RULES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _contains_any(col: str, words) -> str:
    return "coalesce(" + " OR ".join(f"contains({col}, {_q(w)})" for w in words) + ", false)"


POSTS = """
posts AS (
  SELECT p.p_brand AS brand, s.s_name AS store,
    CASE l.l_linenumber
      WHEN 1 THEN concat(CAST(round(l.l_discount * 100) AS INT), '% Off')
      WHEN 2 THEN concat('Up to ', CAST(round(l.l_discount * 100) * 5 AS INT), '% Off + Free Gift')
      WHEN 3 THEN 'Free Full Size Sample'
      WHEN 4 THEN 'BOGO'
      WHEN 5 THEN 'GWP'
      WHEN 6 THEN 'Dealmoon Exclusive! Starting From $52'
      ELSE 'Buy one get one free' END AS discount,
    CASE WHEN l.l_linenumber = 7 AND l.l_tax = 0 THEN 'n/a'
         WHEN l.l_linenumber % 2 = 0 THEN strftime(CAST(l.l_shipdate AS DATE), '%-m/%-d/%Y')
         ELSE strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d') END AS posted_date,
    CASE WHEN l.l_tax = 0 THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS comments_count,
    CAST(l.l_linenumber AS BIGINT) AS bookmarks_count,
    l.l_partkey % 50 AS shares_count
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

PARSED = f"""
parsed AS (
  SELECT brand, store, discount,
    coalesce(CAST(try_strptime(posted_date, '%m/%d/%Y') AS DATE),
             CAST(try_strptime(posted_date, '%Y-%m-%d') AS DATE)) AS posted_date,
    comments_count, bookmarks_count, shares_count,
    CASE WHEN {_contains_any('discount', BOGO_WORDS)} THEN 0.5
         ELSE coalesce(CAST(nullif(regexp_extract(discount, '([0-9]+)%', 1), '') AS DOUBLE) / 100.0, 0.0)
    END AS discount_off,
    {_contains_any('discount', GWP_WORDS)} AS gwp,
    {_contains_any('discount', AD_WORDS)} AS is_ad
  FROM posts)"""

DAILY_FULL = """
daily AS (
  SELECT brand, posted_date, count(*) AS n_posts,
    count(DISTINCT store) AS n_stores, count(DISTINCT discount) AS n_texts,
    CAST(coalesce(sum(comments_count), 0) AS BIGINT) AS comments_count,
    CAST(coalesce(sum(bookmarks_count), 0) AS BIGINT) AS bookmarks_count,
    CAST(coalesce(sum(shares_count), 0) AS BIGINT) AS shares_count,
    max(discount_off) AS discount_off, bool_or(gwp) AS gwp, bool_or(is_ad) AS has_ad
  FROM parsed WHERE posted_date IS NOT NULL
  GROUP BY brand, posted_date)"""

DAILY = """
daily AS (
  SELECT brand, posted_date, count(*) AS n_posts,
    CAST(coalesce(sum(comments_count), 0) AS BIGINT) AS comments_count,
    CAST(coalesce(sum(bookmarks_count), 0) AS BIGINT) AS bookmarks_count,
    CAST(coalesce(sum(shares_count), 0) AS BIGINT) AS shares_count,
    max(discount_off) AS discount_off, bool_or(gwp) AS gwp, bool_or(is_ad) AS has_ad
  FROM parsed WHERE posted_date IS NOT NULL
  GROUP BY brand, posted_date)"""

FILLED = """
bounds AS (
  SELECT brand, min(posted_date) AS first_date, max(posted_date) AS last_date FROM daily GROUP BY brand),
spine AS (
  SELECT brand, CAST(d AS DATE) AS posted_date, first_date, last_date
  FROM bounds, LATERAL unnest(generate_series(CAST(first_date AS TIMESTAMP), CAST(last_date AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d)),
filled AS (
  SELECT s.brand, s.posted_date,
    coalesce(d.n_posts, 0) AS n_posts,
    coalesce(d.comments_count, 0) AS comments_count, coalesce(d.bookmarks_count, 0) AS bookmarks_count,
    coalesce(d.shares_count, 0) AS shares_count, coalesce(d.discount_off, 0.0) AS discount_off,
    coalesce(d.gwp, false) AS gwp, coalesce(d.has_ad, false) AS has_ad,
    CAST(date_diff('day', s.first_date, s.posted_date) + 1 AS INT) AS rn,
    CAST(date_diff('day', s.first_date, s.last_date) + 1 AS INT) AS n
  FROM spine s LEFT JOIN daily d ON s.brand = d.brand AND s.posted_date = d.posted_date),
cal AS (
  SELECT *, CAST(year(posted_date) AS INT) AS year, CAST(month(posted_date) AS INT) AS month,
    CAST(day(posted_date) AS INT) AS day, dayname(posted_date) AS weekday,
    isodow(posted_date) IN (5, 6) AS weekend_flg
  FROM filled)"""


def _nth_sql(y: str, month: int, wd: int, n: int) -> str:
    first = f"make_date({y}, {month}, 1)"
    if n == -1:
        last = f"last_day({first})"
        return f"({last} - CAST((((isodow({last}) - 1) - {wd}) % 7 + 7) % 7 AS INT))"
    return f"({first} + CAST(((({wd} - (isodow({first}) - 1)) % 7 + 7) % 7) + {7 * (n - 1)} AS INT))"


def _holiday_rows() -> str:
    parts = []
    for kind, rules in ((0, FEDERAL_RULES), (1, PARENT_RULES)):
        for name, rule, since in rules:
            if rule[0] == "fixed":
                d = f"make_date(year, {rule[1]}, {rule[2]})"
            else:
                d = _nth_sql("year", rule[1], rule[2], rule[3])
            parts.append(f"SELECT {d} AS holiday_date, {_q(name)} AS holiday_name, {kind} AS kind FROM years WHERE year >= {since}")
    return "\n    UNION ALL ".join(parts)


HOLIDAYS = f"""
years AS (
  SELECT CAST(unnest(range(min(year(posted_date)) - 1, max(year(posted_date)) + 2)) AS INT) AS year FROM filled),
hol AS (
    {_holiday_rows()}),
near_all AS (
  SELECT CAST(holiday_date + CAST(o AS INT) AS DATE) AS posted_date, CAST(abs(o) AS INT) AS dist, kind, holiday_date, holiday_name
  FROM hol, range(-29, 30) AS t(o)),
near AS (
  SELECT posted_date, holiday_name AS near_name, dist AS near_dist FROM (
    SELECT *, row_number() OVER (PARTITION BY posted_date ORDER BY dist, kind, holiday_date, holiday_name) AS rk
    FROM near_all) WHERE rk = 1),
panel AS (
  SELECT c.*,
    CASE WHEN n.near_dist < 1 THEN n.near_name ELSE 'Normal' END AS event_1day,
    CASE WHEN n.near_dist < 7 THEN n.near_name ELSE 'Normal' END AS event_7days,
    CASE WHEN n.near_dist < 14 THEN n.near_name ELSE 'Normal' END AS event_14days,
    CASE WHEN n.near_dist < 30 THEN n.near_name ELSE 'Normal' END AS event_1month
  FROM cal c LEFT JOIN near n ON c.posted_date = n.posted_date)"""


def with_ctes(*frags: str) -> str:
    return "WITH " + ",".join(frags) + "\n"


BASE_PANEL = with_ctes(POSTS, PARSED, DAILY, FILLED, HOLIDAYS)
BASE_FILLED = with_ctes(POSTS, PARSED, DAILY, FILLED)
