"""SQL counterparts of the gate queries."""

from promoledger.queries.promotions_sql import BRANDS, BRIDGE, OFF, ON, PROMOS
from promoledger.queries.sales_sql import LN

ON_TYPES = "('LTYPRG', 'DTRDIS', 'BASKET')"

LAYER = f"""
layers as (
  select ptype, mech, sum(value) as prc, coalesce(sum(case when ptype in {ON_TYPES} then value end), 0) as trn
  from promos where mech not in ('JR', 'NU') group by 1, 2)
"""

SQL = {
    "trading_days_without_sales": """
with days as (
  select cast(unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as date) as day from lineitem),
booked as (
  select distinct case when day(l_shipdate) = 13 then cast(l_shipdate as date) + 1 else cast(l_shipdate as date) end as day from lineitem)
select cast(strftime(day, '%Y%m%d') as integer) as time_key from days
where dayofweek(day) <> 0 and day not in (select day from booked)""",
    "multi_distributor_sites": f"""
with {LN},
s as (select *, cast(l_partkey as varchar) || '-' || cast(mid as varchar) as site_code from ln),
multi as (select site_code from s group by 1 having count(distinct l_suppkey) > 1)
select tk as time_key, cast(l_suppkey as varchar) as distributor_code, site_code,
  cast(l_orderkey as varchar) as invoice_no
from s where site_code in (select site_code from multi)""",
    "control_total_recon": f"""
with {LN},
t as (
  select l_suppkey, tk, sum(cents) as act,
    sum(case when s_acctbal < 0 then cents - floor(cents / 10) else cents end) as tgt, sum(q) as qty
  from ln left join supplier on s_suppkey = l_suppkey group by 1, 2)
select cast(l_suppkey as varchar) as site_code, tk as time_key, cast(act as bigint) as "act_VALUE",
  cast(tgt as bigint) as "tgt_VALUE", cast(act - tgt as bigint) as "delta_VALUE",
  round(abs(act - tgt) / cast(tgt as double) * 100, 4) as "delta_VALUE_prcntg",
  cast(qty as bigint) as "act_QTY", cast(qty as bigint) as "tgt_QTY", cast(0 as bigint) as "delta_QTY",
  cast(0 as double) as "delta_QTY_prcntg"
from t where abs(act - tgt) >= 10 and round(abs(act - tgt) / cast(tgt as double) * 100, 4) >= 5""",
    "missing_dim_keys": f"""
with {LN}
select p_partkey from part where p_partkey not in (select l_partkey from ln where mid = 199601)""",
    "missing_products": f"""
with {PROMOS}
select distinct product_code from promos where ptype in {ON_TYPES}
  and product_code not in (select product_code from hier)""",
    "missing_orders": f"""
with {PROMOS}, {BRANDS}
select distinct io as "IO", case when ptype in {ON_TYPES} then 'ON' else 'OFF' end as invoice_type
from promos where mech not in ('JR', 'NU') and io not in (select io from brands)""",
    "presence_flags": f"""
with {LN},
f as (
  select lpad(cast(p_partkey as varchar), 8, '0') as product_code,
    case when p_partkey in (select l_partkey from ln where mid = 199601) then 'Y' else 'N' end as sold_in_199601,
    case when p_partkey in (select l_partkey from ln where mid = 199701) then 'Y' else 'N' end as sold_in_199701
  from part)
select * from f where sold_in_199601 = 'N' or sold_in_199701 = 'N'""",
    "brands_missing_in_masters": f"""
with {PROMOS}, {BRANDS},
f as (
  select distinct b.io as "IO", b.brand_code,
    case when b.brand_code in (select p_brand from pt where category <> 'Category 2') then 'Y' else 'N' end
      as "brand_code_avail_LPH",
    case when b.brand_code in (select p_brand from pt where fam <> 3) then 'Y' else 'N' end as "brand_code_avail_AM"
  from brands b where b.io in (select io from promos where ptype in ('PERSTR', 'OCCDIS', 'BASKET_BD')
    and mech not in ('JR', 'NU')))
select * from f where "brand_code_avail_LPH" = 'N' or "brand_code_avail_AM" = 'N'""",
    "unknown_types": f"""
with {PROMOS}
select distinct ptype as promotion_type from promos
where case when ptype = 'BASKET_BD' then 'BASKET' else ptype end not in {ON_TYPES}""",
    "unexpected_gifts": f"""
with {PROMOS}
select base_type as promotion_type, mech as promotion_mechanism, count(*) as row_count
from promos where mech = 'LN' and base_type not in ('BASKET', 'LTYPRG') group by 1, 2""",
    "dup_keys": """
select l_orderkey, l_partkey, count(*) as cnt from lineitem group by 1, 2 having count(*) > 1""",
    "row_counts": """
select (select count(*) from orders) as rows_before, (select count(*) from lineitem) as rows_after
where (select count(*) from orders) <> (select count(*) from lineitem)""",
    "type_profile": f"""
with {PROMOS}
select base_type as promotion_type, count(*) as row_count from promos group by 1""",
    "missing_salesman": """
select count(*) as null_rows from lineitem
where l_suppkey not in (select s_suppkey from supplier where s_acctbal >= 0)""",
    "layer_recon_pct": f"""
with {PROMOS}, {LAYER}
select ptype as promotion_type, mech as promotion_mechanism, cast(round(prc) as bigint) as prc_promotion_value,
  cast(round(trn) as bigint) as trn_promotion_value,
  round((abs(round(prc)) - abs(round(trn))) * 100 / nullif(abs(round(prc)), 0), 4) as delta_prcntg
from layers
where abs((abs(round(prc)) - abs(round(trn))) * 100 / nullif(abs(round(prc)), 0)) >= 10
  and not (ptype = 'BBFREE' and mech = 'FQ')""",
    "layer_recon_exact": f"""
with {PROMOS}, {BRANDS}, {ON}
select ptype as promotion_type, mech as promotion_mechanism, cast(round(sum(value)) as bigint) as trn_promotion_value,
  cast(round(sum(value)) as bigint) as agg_promotion_value, cast(0 as bigint) as delta_promotion_value
from on_rows where mech not in ('JR', 'NU') group by 1, 2""",
    "layer_totals": f"""
with {PROMOS}
select '1 processed' as layer, ptype as promotion_type, mech as promotion_mechanism,
  cast(round(sum(value)) as bigint) as promotion_value
from promos group by 2, 3
union all
select '2 transformed', ptype, mech, cast(round(sum(value)) as bigint)
from promos where ptype in {ON_TYPES} group by 2, 3""",
    "ungrouped_off_rows": f"""
with {PROMOS}, {BRANDS}, {BRIDGE}, {OFF}
select mech as promotion_mechanism, ptype as promotion_type, count(*) as row_count
from off_lines l where ptype <> 'PERSTR' and io not in (select io from brands) group by 1, 2""",
    "scope_mismatch": """
select case when s_acctbal >= 0 then cast(s_suppkey as varchar) end as site_code,
  case when s_acctbal >= -500 then cast(s_suppkey as varchar) end as listed_site
from supplier where s_acctbal < 0 and s_acctbal >= -500""",
    "returned_invoice_days": f"""
with {LN},
firsts as (
  select l_partkey, mid, l_orderkey as original
  from (select *, row_number() over (partition by l_partkey, mid order by tk, cast(l_orderkey as varchar)) as rn
        from ln where rf <> 'R') where rn = 1),
referred as (
  select distinct original, ln.l_partkey from ln join firsts f on f.l_partkey = ln.l_partkey and f.mid = ln.mid
  where rf = 'R')
select tk as time_key, count(*) as row_count from ln
where (l_orderkey, l_partkey) in (select original, l_partkey from referred) group by 1""",
    "latest_batch_counts": f"""
with {LN}
select yid as update_ts, tk as time_key, count(*) as row_count from ln
where tk between 20000115 and 20000225
  and mid = (select max(mid) from ln where tk between 20000115 and 20000225)
group by 1, 2""",
    "invoice_trace": f"""
with {PROMOS}
select tk as time_key, count(*) as row_count, cast(sum(cast(round(value) as bigint)) as bigint) as promotion_value
from promos where ptype = 'LTYPRG' and io = 'LN00000003' group by 1""",
}
