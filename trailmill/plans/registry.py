"""Query registry and the SQL text of the two click views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CLICKS_CTE = """
e as (
  select event_id, user_id, ts, event_type, value,
         cast(json_extract_string(props, '$.k') as int) as k, epoch_us(ts) as us
  from events),
g as (
  select *, case when us - lag(us) over (partition by user_id order by us, event_id) <= 86400000000
                 then 0 else 1 end as brk from e),
s as (
  select *, sum(brk) over (partition by user_id order by us, event_id
                           rows between unbounded preceding and current row) as sn from g),
o as (
  select *, cast(row_number() over (partition by user_id, sn order by us, event_id) as int) as click_order
  from s),
clicks as (
  select cast(user_id::bigint * 1000000000 + sn as bigint) as session_id, click_order,
         cast(user_id % 47 + 1 as int) as country, event_type as category,
         concat('K', cast(k as varchar)) as item_id, k as item_no,
         cast(k % 14 + 1 as int) as colour, cast(k % 6 + 1 as int) as location,
         cast(k % 2 + 1 as int) as photo_type, value as price,
         value > avg(value) over (partition by event_type) as price_above_avg,
         cast(least(5, floor((click_order - 1) / 4) + 1) as int) as page,
         cast(ts as date) as click_date
  from o),
located as (
  select *, case when country in (29) then 'Poland'
      when country in (2,3,8,9,10,11,14,15,16,17,18,21,22,23,24,25,27,30,34,35,36,37,41) then 'Other_EU'
      when country in (7,19,28,31,32,33,38,39) then 'Europe_non_EU'
      when country in (1,4,5,6,20,26,40,42) then 'Outside_Europe'
      else 'Unidentified_or_Domain' end as region
  from clicks)"""

BASKETS_CTE = """
baskets as (
  select l_orderkey as session_id,
         cast(row_number() over (partition by l_orderkey
              order by l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice) as int) as click_order,
         c_nationkey as country, r_name as region, p_type as category, p_brand as colour,
         l_partkey as item_id, p_retailprice as price, l_linenumber as page,
         cast(o_orderdate as date) as click_date
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey)"""


def on_clicks(select: str, ctes: str = "") -> str:
    return f"with recursive {CLICKS_CTE}{',' + ctes if ctes else ''}\n{select}"


def on_baskets(select: str, ctes: str = "") -> str:
    return f"with recursive {BASKETS_CTE}{',' + ctes if ctes else ''}\n{select}"


def mean_sql(column: str) -> str:
    """SQL twin of ``functions.aggregates.exact_mean``."""
    return f"cast(sum(cast({column} as decimal(18,4))) as double) / count({column})"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register
