"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL twin if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables hold times without a zone; they mean UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from equigauge.plans import (  # noqa: F401
        q_drift,
        q_fairness,
        q_models,
        q_monitor,
        q_profile,
        q_tables,
    )


# --- SQL fragments shared by the twins ------------------------------------------

RAW = """
li as (select l_orderkey, sum(l_quantity) as hrs from lineitem group by l_orderkey),
raw as (
  select o_orderkey as person_id, o_totalprice as wage_income,
    cast(floor(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) / 30) as int) as age,
    substr(o_orderpriority, 1, 1) as education,
    lpad(cast(c_nationkey * 10 as varchar), 4, '0') as occupation,
    c_mktsegment as class_of_worker, o_orderstatus as marital_status, hrs as hours_per_week,
    1 + o_custkey % 7 as person_weight,
    cast(n_regionkey + 1 as varchar) as race, cast(1 + c_custkey % 2 as varchar) as sex,
    case when c_nationkey < 20 then '1' else '2' end as nativity, o_orderdate as order_ts
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    left join li on o_orderkey = l_orderkey)"""

SCORED = (
    RAW
    + """,
z as (
  select *, cast(wage_income >= 390000 as int) as high_income,
    (wage_income - 38e4) / 1e5 + 2e-3 * (coalesce(hours_per_week, 1e2) - 1e2)
    + 2e0 * ((person_id * 7919) % 1000 / 1e3 - 5e-1)
    + case when race = '4' then 15e-1 else 0e0 end as zz
  from raw where wage_income >= 0 and age >= 18),
s as (select *, 5e-1 + 5e-1 * zz / (1e0 + abs(zz)) as score from z),
a as (select *, cast(score >= 5e-1 as int) as pred from s)"""
)

SPLIT = (
    SCORED
    + """,
ranked as (
  select *, row_number() over (partition by high_income order by md5(person_id || '-42')) as rnk,
    count(*) over (partition by high_income) as class_n
  from a),
sp as (select *, rnk <= floor(2e-1 * class_n + 5e-1) as is_test from ranked)"""
)


def raw_sql(body: str, ctes: str = "") -> str:
    return f"with {RAW}{',' if ctes else ''}{ctes}\n{body}"


def scored_sql(body: str, ctes: str = "") -> str:
    return f"with {SCORED}{',' if ctes else ''}{ctes}\n{body}"


def split_sql(body: str, ctes: str = "") -> str:
    return f"with {SPLIT}{',' if ctes else ''}{ctes}\n{body}"


def r4(expression: str) -> str:
    return f"floor(({expression}) * 1e4 + 5e-1) / 1e4"
