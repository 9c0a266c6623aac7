"""SQL counterparts of the sales queries."""

LN = """
ln as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity as q, l_returnflag as rf, l_linestatus as ls,
    l_shipdate, cast(round(l_extendedprice * 100) as bigint) as cents,
    cast(round(l_discount * 100) as bigint) as dp, cast(round(l_tax * 100) as bigint) as tp,
    cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as integer) as tk,
    cast(year(l_shipdate) * 100 + month(l_shipdate) as integer) as mid,
    cast(year(l_shipdate) as integer) as yid
  from lineitem)
"""

LO = LN + """,
lo as (
  select ln.*, o_custkey, o_orderpriority, lpad(cast(o_custkey as varchar), 10, '0') as outlet_code,
    lpad(cast(l_partkey as varchar), 8, '0') as product_code
  from ln join orders on o_orderkey = l_orderkey)
"""

PT = """
pt as (
  select p_partkey, lpad(cast(p_partkey as varchar), 8, '0') as product_code, p_name, p_brand, p_type, p_size,
    cast(substring(p_brand, 7) as integer) as bn,
    'Category ' || cast((cast(substring(p_brand, 7) as integer) - 1) % 5 + 1 as varchar) as category,
    'Division ' || cast(cast(substring(p_brand, 7) as integer) % 2 + 1 as varchar) as division,
    cast(floor((cast(substring(p_brand, 7) as integer) + 4) / 5) as integer) as fam,
    cast(round(p_retailprice * 100) as bigint) as pcents,
    case when p_size <= 10 then 0 when p_size <= 20 then 1 when p_size <= 30 then 2 when p_size <= 40 then 4
         else 8 end as su,
    case when p_size <= 7 then p_name || ' (1+A)' else p_name end as descr
  from part)
"""

HIER = PT + """,
hier as (
  select product_code, descr as product_desc, p_name as dp_name, p_brand as brand_code, category, division,
    'Market ' || cast(fam as varchar) as master_market, p_type as lead_basepack_code,
    case when p_size <= 7 or p_type = 'PROMO' then 'Banded' else 'Non-Banded' end as banded,
    min(product_code) over (partition by p_brand) as standard_product_group_code
  from pt where p_size <> 50)
"""

AVG = """
avg3 as (
  select outlet_code, sum(s) / 3.0 as mean
  from (
    select o.outlet_code, m.mid, coalesce(sum(lo.cents), 0) as s
    from (select distinct outlet_code from lo where mid between 200011 and 200101) o
    cross join (select unnest([200011, 200012, 200101]) as mid) m
    left join lo on lo.outlet_code = o.outlet_code and lo.mid = m.mid
    group by o.outlet_code, m.mid)
  group by outlet_code),
bands as (select * from (values (1, 0.0, 5000000.0), (2, 5000000.5, 12000000.0), (3, 12000000.5, 30000000.0))
          as b(code, p1, p2)),
sizes as (
  select outlet_code, coalesce(code, 0) as store_size_code
  from avg3 left join bands on mean between p1 and p2)
"""

CODED = """
channels as (
  select distinct case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end as channel
  from customer),
coded_channel as (select channel, row_number() over (order by channel) as code from channels)
"""

SQL = {
    "mixed_key_join": """
select p_brand as brand, count(*) as row_count, cast(sum(round(l_quantity)) as bigint) as pieces
from lineitem left join part on p_partkey = l_partkey group by 1""",
    "conform_sales": f"""
with {LO}
select product_code, cast(l_orderkey as varchar) as invoice_number,
  cast(l_suppkey as varchar) || '_' || cast(yid as varchar) as site_code_year,
  outlet_code as transactional_outlet_code, tk as time_key, mid as month_id,
  case when rf = 'A' then 0 else cents * 100 end as gross_sales_val,
  round(case when rf = 'A' then 0.0 else cents * 100 / 1000000.0 end, 6) as gross_sales_val_mn,
  case when rf = 'R' then 0 else cents end as net_invoice_val,
  cast(0 as bigint) as turn_over_val, cast(q as integer) as sales_pc_qty
from lo where tp < 8""",
    "trailing_minus_parse": f"""
with {LN}
select rf as l_returnflag, cast(sum(case when rf = 'R' then -cents else cents end) as bigint) as signed_cents,
  cast(sum(cents) as bigint) as unsigned_cents, count(*) as row_count
from ln group by rf""",
    "latest_snapshot": """
select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as y, cast(month(o_orderdate) as integer) as m,
  cast(day(o_orderdate) as integer) as d
from orders where o_orderdate = (select max(o_orderdate) from orders)""",
    "enrich_star": f"""
with {LN}
select p_brand || '_' || p_type || '_' || cast(p_size as varchar) as brand_cat_core, yid as year_id,
  count(*) as row_count, cast(sum(cents) as bigint) as gross_sales_val,
  min('SF' || cast(s_nationkey as varchar)) as first_salesforce
from ln left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey
group by 1, 2""",
    "master_restatement": f"""
with {LO}, {PT},
moved as (
  select c_custkey, c_nationkey, min(c_custkey) over (partition by c_nationkey) as first_outlet, c_acctbal
  from customer),
restated as (
  select coalesce(lpad(cast(m.first_outlet as varchar), 10, '0'), lo.outlet_code) as master_outlet_code,
    pt.division, lo.cents, case when m.c_custkey is null then 0 else 1 end as restated, s_nationkey
  from lo left join (select * from moved where c_acctbal < 0) m on m.c_custkey = lo.o_custkey
  left join pt on pt.p_partkey = lo.l_partkey
  left join supplier on s_suppkey = lo.l_suppkey)
select master_outlet_code, c_mktsegment as master_spg, division, count(*) as row_count,
  cast(sum(cents) as bigint) as gross_sales_val, cast(sum(restated) as bigint) as restated_rows,
  cast(sum(s_nationkey) as bigint) as salespersons
from restated left join (select * from customer where c_mktsegment <> 'HOUSEHOLD') c
  on lpad(cast(c_custkey as varchar), 10, '0') = master_outlet_code
group by 1, 2, 3""",
    "site_semi_filter": f"""
with {LN}
select cast(l_suppkey as varchar) as site_code, count(*) as row_count, cast(sum(cents) as bigint) as gross_sales_val
from ln where l_suppkey in (select s_suppkey from supplier where s_acctbal >= 0)
  and l_orderkey in (select o_orderkey from orders)
group by 1""",
    "trailing_avg": f"""
with {LO}, {AVG}
select outlet_code, round(mean, 6) as avg_gross_sales_mn from avg3""",
    "interval_bands": f"""
with {LN}, {PT},
bands as (
  select product_code, case when not (p_size = 1 and p_brand = 'Brand#13') then pcents * 10 end as low,
    case when not (p_size = 50 and p_brand = 'Brand#25') then pcents * 10 + p_size * 100 end as high
  from pt),
amounts as (select cents, count(*) as n from ln group by 1)
select product_code, cast(sum(n) as bigint) as row_count, cast(sum(n * cents) as bigint) as gross_cents
from bands join amounts on cents >= coalesce(low, cents) and cents <= coalesce(high, cents)
where low is not null or high is not null group by 1""",
    "store_size_band": f"""
with {LO}, {AVG}
select outlet_code, cast(store_size_code as integer) as store_size_code from sizes""",
    "coded_dims": f"""
with {CODED}
select 'CHANNEL' as ref_type, channel as ref_desc, cast(code as integer) as ref_code,
  cast(null as double) as param1, cast(null as double) as param2 from coded_channel
union all
select 'REGION', r_name, cast(r_regionkey + 1 as integer), null, null from region
union all
select 'CATEGORY', category, cast(row_number() over (order by category) as integer), null, null
from (select distinct 'Category ' || cast((cast(substring(p_brand, 7) as integer) - 1) % 5 + 1 as varchar) as category
      from part where p_size <> 50)
union all
select * from (values ('PERFECT_STORE', 'YES', 1, null, null), ('PERFECT_STORE', 'NO', 0, null, null),
  ('BUDGET_HOLDER_GRP', 'Brand', 1, null, null), ('BUDGET_HOLDER_GRP', 'Customer', 2, null, null),
  ('BUDGET_HOLDER_GRP', 'Trade Marketing', 3, null, null), ('BUDGET_HOLDER_GRP', 'Distributor', 99, null, null),
  ('STORE_SIZE_CLASS', 'SMALL', 1, 0.0, 5000000.0), ('STORE_SIZE_CLASS', 'MEDIUM', 2, 5000000.5, 12000000.0),
  ('STORE_SIZE_CLASS', 'LARGE', 3, 12000000.5, 30000000.0)) as t""",
    "monthly_sales": f"""
with {LO}, {HIER}, {AVG}, {CODED},
grouped as (
  select cast(strftime(last_day(l_shipdate), '%Y%m%d') as integer) as time_key, product_code, l_suppkey, outlet_code,
    sum(cents) as gross, sum(cents * (100 - dp)) as net, sum(cents * dp) as disc, sum(cents * tp) as tax,
    sum(q) as qty
  from lo where product_code not like '0000075%'
  group by 1, 2, 3, 4)
select g.time_key, r_name as region, cast(coalesce(cc.code, 0) as integer) as channel_code,
  cast(coalesce(s.store_size_code, 0) as integer) as store_size_code,
  case when c.c_acctbal >= 5000 then 1 else 0 end as perfect_store_status_code,
  coalesce(h.banded, 'NA') as banded,
  cast(sum(gross) as bigint) as gross_sales_val, cast(sum(net) as bigint) as net_invoice_val,
  cast(sum(disc) as bigint) as on_invoice_discount_val, cast(sum(tax) as bigint) as value_added_tax,
  cast(sum(qty) as bigint) as sales_pc_qty, count(*) as row_count
from grouped g
left join hier h on h.product_code = g.product_code
left join supplier on s_suppkey = g.l_suppkey
left join nation on n_nationkey = s_nationkey
left join region on r_regionkey = n_regionkey
left join customer c on lpad(cast(c_custkey as varchar), 10, '0') = g.outlet_code
left join coded_channel cc
  on cc.channel = case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end
left join sizes s on s.outlet_code = g.outlet_code
group by 1, 2, 3, 4, 5, 6""",
    "upsert": f"""
with {LN},
keyed as (
  select product_code, invoice_number, tk, cents
  from (select lpad(cast(l_partkey as varchar), 8, '0') as product_code, cast(l_orderkey as varchar) as invoice_number,
          tk, cents, row_number() over (partition by l_partkey, l_orderkey order by tk desc, cents desc) as rn from ln)
  where rn = 1)
select product_code, invoice_number, case when tk < 19990101 then tk else tk + 1 end as time_key,
  case when tk >= 19980101 then cents + 100 else cents end as gross_cents,
  case when tk < 19990101 then 'first' else 'second' end as insert_ts
from keyed""",
    "delete_latest_batch": f"""
with {LN}
select mid as insert_ts, count(*) as row_count, cast(sum(cents) as bigint) as gross_cents
from ln
where not (tk between 20000115 and 20000210
  and mid = (select max(mid) from ln where tk between 20000115 and 20000210))
group by mid""",
    "restate_returns": f"""
with {LN},
item as (
  select cast(l_orderkey as varchar) as invoice_number, lpad(cast(l_partkey as varchar), 8, '0') as product_code,
    tk, mid, rf, cents from ln),
firsts as (
  select product_code, mid, invoice_number as original
  from (select *, row_number() over (partition by product_code, mid order by tk, invoice_number) as rn
        from item where rf <> 'R') where rn = 1),
fact as (
  select item.*, case when rf = 'R' and original is not null then original else '0' end as ref
  from item left join firsts using (product_code, mid)
  where item.mid in (200002, 200003)),
src as (
  select r.invoice_number, r.product_code, min(o.tk) as new_tk
  from (select distinct invoice_number, product_code, ref from fact where mid = 200003 and ref <> '0') r
  join fact o on o.invoice_number = r.ref and o.product_code = r.product_code
  group by 1, 2)
select f.invoice_number, f.product_code, coalesce(new_tk, tk) as time_key,
  cast(floor(coalesce(new_tk, tk) / 100) as integer) as month_id, ref as sales_ret_ref_invoice_number,
  cents as gross_cents
from fact f left join src s on s.invoice_number = f.invoice_number and s.product_code = f.product_code""",
}
