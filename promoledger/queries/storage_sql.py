"""SQL counterparts of the storage queries."""

from promoledger.queries.sales_sql import LN

SQL = {
    "month_reload": f"""
with {LN}
select mid as month_id, count(*) as row_count,
  cast(sum(case when mid = 199803 then cents * 2 else cents end) as bigint) as gross_cents
from ln where not (mid = 199803 and tk % 100 = 1) group by 1""",
    "partition_write_read": f"""
with {LN}, t as (select mid, case when mid = 199702 then -cents else cents end as cents from ln)
select mid as month_id, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents, 'table' as scope
from t group by 1
union all
select mid, count(*), cast(sum(cents) as bigint), 'partition' from t where mid = 199702 group by 1""",
    "calendar_scope": f"""
with {LN},
days as (select cast(unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as date) as day from lineitem),
months as (
  select year(day) * 100 + month(day) as mid from days where month(day) % 3 = 0
  group by 1 having count(*) filter (dayofweek(day) <> 0) >= 26)
select mid as month_id, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents from ln where mid in (select mid from months)
group by 1""",
    "export_window": f"""
with {LN}
select l_orderkey, l_partkey, tk as time_key, cents as gross_cents from ln where tk between 20000227 and 20000304""",
    "upsert_stored": f"""
with {LN},
keyed as (
  select l_partkey, l_orderkey, tk, mid, cents
  from (select *, row_number() over (partition by l_partkey, l_orderkey order by tk desc, cents desc) as rn from ln)
  where rn = 1),
kept as (
  select mid, case when mid = 200003 and cents % 2 = 1 then 2099010 else mid * 10 + cents % 2 end as ts,
    case when mid = 200003 then cents + 7 else cents end as cents
  from keyed)
select mid as month_id, cast(ts as bigint) as insert_ts, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents
from kept group by 1, 2""",
    "returns_in_place": f"""
with {LN},
item as (
  select cast(l_orderkey as varchar) as invoice_number, l_partkey, tk, mid, rf, cents from ln),
firsts as (
  select l_partkey, mid, invoice_number as original
  from (select *, row_number() over (partition by l_partkey, mid order by tk, invoice_number) as rn from item where rf <> 'R')
  where rn = 1),
fact as (
  select item.*, case when rf = 'R' and original is not null then original else '0' end as ref
  from item left join firsts using (l_partkey, mid)),
src as (
  select r.invoice_number, r.l_partkey, min(o.tk) as new_tk
  from (select distinct invoice_number, l_partkey, ref from fact where mid = 200003 and ref <> '0') r
  join fact o on o.invoice_number = r.ref and o.l_partkey = r.l_partkey and o.mid in (200002, 200003)
  group by 1, 2),
stored as (
  select cast(floor(case when mid in (200002, 200003) then coalesce(new_tk, tk) else tk end / 10) * 10 as integer) as tk, ref, cents
  from fact f left join src s on s.invoice_number = f.invoice_number and s.l_partkey = f.l_partkey)
select cast(floor(tk / 10000) as integer) as year_id, cast(floor(tk / 100) as integer) as month_id, tk as time_key,
  count(*) as row_count, cast(sum(cents) as bigint) as gross_cents, count(*) filter (ref <> '0') as returned_rows
from stored group by tk""",
    "daily_job": f"""
with {LN},
t as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as invoice, cast(substring(p_brand, 7) as integer) as brand, rf, tk, mid,
    cents, l_suppkey from ln join part on p_partkey = l_partkey),
firsts as (
  select brand, mid, tk as first_tk from (
    select *, row_number() over (partition by brand, mid order by tk, invoice) as rn from t where rf <> 'R') where rn = 1),
loaded as (
  select t.*, case when rf = 'R' and first_tk <= tk then first_tk else tk end as booked
  from t left join firsts using (brand, mid) where tk between 20000301 and 20000303),
fact as (
  select invoice as invoice_number, lpad(cast(brand as varchar), 8, '0') as product_code, booked as time_key, mid as month_id,
    cents * 100 as gross_value, 'SF' || cast(s_nationkey as varchar) as salesforce, 'B' || cast(brand as varchar) || '_C_K' as brand_cat_core,
    cast(case when tk = 20000303 then 4 else tk - 20000300 end as integer) as run
  from loaded left join supplier on s_suppkey = l_suppkey)
select *, 'fact' as layer from fact union all select *, 'export' from fact""",
    "history_two_batches": f"""
with {LN},
t as (
  select case when rf = 'R' then 'returns' else 'sales' end as batch_id,
    case when not (l_linenumber = 1 and tp >= 8) then mid end as month_id, cents * 100 as v,
    l_suppkey in (select s_suppkey from supplier) as known
  from ln)
select batch_id, month_id, count(*) as row_count, cast(sum(v) as bigint) as gross_value,
  case when month_id is null then 0 else count(*) filter (known) end as with_salesforce
from t group by 1, 2""",
    "pii_roundtrip": "select c_custkey, c_name from customer",
    "snapshot_master": """
select lpad(cast(p_partkey as varchar), 8, '0') as material_code,
  cast(round(p_retailprice * 100) as bigint) * case when p_size > 40 then -1 else 1 end as price_cents,
  p_size as "PC_per_SU", '2019-01-28' as creation_date, p_brand as "PH7_code", cast(null as varchar) as param1
from part""",
    "report_export_read": f"""
with {LN},
d as (
  select distinct tk, mid, l_suppkey, l_orderkey, l_linenumber, l_partkey, rf, cents from ln
  where l_suppkey in (select s_suppkey from supplier where s_acctbal >= 0))
select rf as promotion_type, cast(mid as bigint) as month_id, count(*) as row_count,
  cast(sum(case when rf = 'R' then -cents else cents end) as bigint) as value_cents
from d group by 1, 2""",
    "newest_stored_snapshot": """
select c_mktsegment, count(*) as row_count, cast(sum(c_custkey) as bigint) as code_sum from customer group by 1""",
}
