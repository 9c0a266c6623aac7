"""SQL counterparts of the dimension queries."""

from promoledger.queries.sales_sql import CODED

SQL = {
    "dynamic_axis": f"""
with {CODED},
r as (select r_name as region, cast(r_regionkey + 1 as integer) as ri from region union all select 'ALL', 100000),
c as (select channel, cast(code + 10 as integer) as ci from coded_channel union all select 'ALL', 100000),
s as (select * from (values ('SMALL', 21), ('MEDIUM', 22), ('LARGE', 23), ('ALL', 100000)) as t(size_class, si)),
k as (
  select category, cast(row_number() over (order by category) + 30 as integer) as ki
  from (select distinct 'Category ' || cast((cast(substring(p_brand, 7) as integer) - 1) % 5 + 1 as varchar) as category
        from part where p_size <> 50)
  union all select 'ALL', 100000),
a as (select * from (values ('Region', 1), ('Channel', 2), ('Store Size', 3), ('Product Category', 4)) as t(axis, ai))
select axis as axis_dimension, ai as axis_dimension_index, region, ri as region_index, channel, ci as channel_index,
  size_class as store_size_class, si as store_size_index, category, ki as category_index,
  case ai when 1 then region when 2 then channel when 3 then size_class else category end as axis_value,
  case ai when 1 then ri when 2 then ci when 3 then si else ki end as axis_index
from a, r, c, s, k""",
    "promo_axis": """
with d as (select distinct o_orderpriority as t, cast(substring(o_orderpriority, 1, 1) as integer) as i from orders),
s as (select distinct l_returnflag as t, cast(ascii(l_returnflag) as integer) as i from lineitem),
g as (select distinct c_mktsegment as t from customer union all select 'Distributor'),
b as (select t, cast(30 + row_number() over (order by t) as integer) as i from g),
a as (select * from (values ('DETAILED', 1), ('SUMMARIZED', 2), ('BUDGET HOLDER', 3)) as t(axis, ai))
select axis as axis_dimension, ai as dimension_index,
  case ai when 1 then d.t when 2 then s.t else b.t end as axis_value,
  case ai when 1 then d.i when 2 then s.i else b.i end as axis_index,
  s.t as promo_summarised, d.t as promotion_type, b.t as budget_holder
from a, d, s, b""",
    "trading_calendar": """
with days as (
  select cast(unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as date) as day from lineitem)
select cast(strftime(day, '%Y%m%d') as integer) as time_key, cast(strftime(day, '%Y%m') as integer) as year_month,
  case when dayofweek(day) = 0 then 0 else 1 end as trading_day
from days""",
    "scope_lists": """
select kind, cast(s_suppkey as varchar) as code
from supplier cross join (select unnest(['site', 'distributor']) as kind) k
where s_acctbal >= 0""",
}
