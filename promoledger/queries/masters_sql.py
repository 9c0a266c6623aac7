"""SQL counterparts of the master and catalog queries."""

from promoledger.queries.sales_sql import LN, LO

SQL = {
    "masters_with_rejects": """
with bh as (select n_regionkey as v, (n_regionkey = 2)::int as r from nation),
gm as (
  select p_size as v, (p_size > 40)::int + (p_size > 48)::int as r from part),
io as (
  select cast(round(o_totalprice * 100) as bigint) as v, (o_orderpriority = '5-LOW')::int + (o_orderstatus = 'P')::int as r from orders),
lp as (select cast(substring(p_brand, 7) as integer) as v, (p_size >= 50)::int as r from part),
ps as (
  select count(*) as v, (year(o_orderdate) = 1996)::int as r from orders group by year(o_orderdate), quarter(o_orderdate), o_orderpriority),
rows_ as (
  select 'budget_holder' as master, * from bh union all select 'gift_master', * from gm union all select 'io_master', * from io
  union all select 'local_product', * from lp union all select 'promotion_split', * from ps)
select master, count(*) filter (r = 0) as row_count, cast(sum(v) filter (r = 0) as bigint) as checksum, count(*) filter (r > 0) as n_first,
  count(*) filter (r > 0) as n_second, cast(case when sum(r) > 0 then 2 * sum(r) end as bigint) as n_reasons
from rows_ group by 1""",
    "month_fallback": """
with asked as (select unnest([('202008', 8), ('202009', 8), ('202012', 10)]) as a)
select a[1] as month_id, c_mktsegment, count(*) as row_count from asked join customer on c_nationkey < a[2] group by 1, 2""",
    "catalog_partitions": f"""
with {LN}
select yid as year_id, mid as month_id, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents from ln group by 1, 2""",
    "exception_table": "select c_custkey as outlet, c_mktsegment as segment from customer where c_acctbal < 0",
    "catalog_statistics": f"""
with {LO}
select c_mktsegment, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents
from lo join customer on c_custkey = o_custkey where c_acctbal > 9000 group by 1""",
}
