"""SQL counterparts of the facts at full grain."""

from promoledger.queries.promotions_sql import ALLOCATED, BRANDS, BRIDGE, DAILY, GIFT, OFF, ON, PROMOS, SHARE
from promoledger.queries.sales_sql import AVG, CODED, HIER, LO

_SUMS = {
    "gross_sales_val": "cents", "gross_sales_val_mn": "cents * 2", "net_invoice_val": "cents * (100 - dp)",
    "gross_sales_return_val": "case when rf = 'R' then cents else 0 end", "sales_return_val": "case when rf = 'R' then cents * dp else 0 end",
    "on_invoice_discount_val": "cents * dp", "value_added_tax": "cents * tp", "off_inv_discount_val": "tp", "turn_over_val": "cents - dp",
    "sales_cs_vol": "floor(q / 10)", "sales_kg_vol": "q * 3", "sales_lt_vol": "dp", "sales_with_return_pc_qty": "q",
    "sales_return_pc_qty": "case when rf = 'R' then q else 0 end", "sales_pc_qty": "q", "free_pc_qty": "cast(q as bigint) % 10",
}

# Codes of an outlet and a site.
_OUTLET = """
outlet_codes as (
  select lpad(cast(c_custkey as varchar), 10, '0') as outlet_code, cast(coalesce(cc.code, 0) as integer) as channel_code,
    case when c_acctbal >= 5000 then 1 else 0 end as perfect,
    case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end as channel, s.store_size_code as size_code
  from customer
  left join coded_channel cc on cc.channel = case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end
  left join sizes s on s.outlet_code = lpad(cast(c_custkey as varchar), 10, '0')),
site_regions as (
  select s_suppkey, r_name as region from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey)
"""

_FACTS = f"with {PROMOS}, {BRANDS}, {BRIDGE}, {SHARE}, {OFF}, {ALLOCATED}, {ON}, {GIFT}, {DAILY}"

_MONTHS = """
month_all as (
  select l_suppkey, outlet_code, case when invoice_type = 'OFF' then coalesce(product_code, 'NA') else product_code end as product_code, spg,
    banded, ptype, mech, promotion_id, holder, invoice_type, available, cast(floor(tk / 100) as integer) as mid,
    cast(strftime(last_day(strptime(cast(tk as varchar), '%Y%m%d')), '%Y%m%d') as integer) as time_key, sum(value) as value
  from daily group by all),
ranked as (
  select *, row_number() over (partition by time_key, outlet_code, product_code
      order by ptype, cast(l_suppkey as varchar), spg nulls first, banded, mech, promotion_id, holder, available) as rn
  from month_all where invoice_type = 'OFF'),
totals as (
  select time_key, outlet_code, product_code, sum(case when ptype = 'OCCDIS' then value else 0 end) as occ,
    sum(case when ptype = 'PERSTR' then value else 0 end) as per, sum(case when ptype in ('OCCDIS', 'PERSTR') then value else 0 end) as dis,
    sum(case when ptype = 'LTYPRG' then value else 0 end) as lty
  from month_all where invoice_type = 'OFF' group by 1, 2, 3),
marked as (
  select r.* exclude (rn), t.occ, t.per, t.dis, t.lty from ranked r
  left join totals t on t.time_key = r.time_key and t.outlet_code = r.outlet_code and t.product_code = r.product_code and rn = 1
    and mech not in ('JR', 'NU')
  union all
  select *, 0, 0, 0, 0 from month_all where invoice_type = 'ON')
"""


def _flag(condition: str) -> str:
    return f"cast(case when {condition} then 1 when occ is not null then 0 end as integer)"


SQL = {
    "monthly_sales_full": f"""
with {LO}, {HIER}, {AVG}, {CODED}, {_OUTLET},
grouped as (
  select case when tp >= 8 then 'TH' else 'VN' end as country_code, product_code, l_partkey, l_orderkey, l_suppkey, outlet_code, ls, rf, yid, mid,
    last_day(l_shipdate) as day, {', '.join(f'cast(sum({c}) as bigint) as {n}' for n, c in _SUMS.items())}
  from lo where product_code not like '0000075%' group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)
select country_code, g.product_code, h.standard_product_group_code, region, cast(l_orderkey as varchar) as invoice_number,
  cast(l_suppkey as varchar) || '_' || cast(yid as varchar) as site_code_year, cast(l_suppkey as varchar) as transactional_distributor_code,
  cast(l_suppkey as varchar) as transactional_site_code, g.outlet_code as transactional_outlet_code, coalesce(channel_code, 0) as channel_code,
  cast(case when size_code = 0 then null else size_code end as integer) as store_size_code, perfect as perfect_store_status_code,
  0 as region_code, case when h.banded = 'Banded' then 1 else 0 end as banded_code, strftime(day, '%Y-%m-%d') as invoice_date,
  cast(l_suppkey as varchar) as transactional_salesman_code, ls as invoicetype, rf as "customer_ZRSS_flag", {', '.join(_SUMS)},
  'SF' || cast(s_nationkey as varchar) as salesforce, p_brand as brand, p_type as category_code,
  p_brand || '_' || p_type || '_' || cast(p_size as varchar) as brand_cat_core, coalesce(h.banded, 'NA') as banded,
  yid as year_id, mid as month_id, cast(strftime(day, '%Y%m%d') as integer) as time_key
from grouped g left join hier h on h.product_code = g.product_code left join part on p_partkey = l_partkey
left join supplier s on s.s_suppkey = g.l_suppkey left join site_regions r on r.s_suppkey = g.l_suppkey
left join outlet_codes o on o.outlet_code = g.outlet_code""",
    "daily_promotions_typed": f"""
{_FACTS}, {CODED}
select cast(l_orderkey as varchar) as invoice_number, product_code, spg as standard_product_group_code, promotion_id, io as "IO",
  mech as promotion_mechanism, 'promotion' as promotion_desc, ptype as promotion_type, holder as budget_holder_group, invoice_type,
  '1995-01-01' as promo_start_date, '2001-12-31' as promo_end_date, cast(round(coalesce(vbd, 0)) as bigint) as value_based_promo_disc,
  cast(round(coalesce(hld, 0)) as bigint) as header_lvl_disc, cast(round(coalesce(fqv, 0)) as bigint) as free_quantity_value,
  cast(round(coalesce(value, 0)) as bigint) as promotion_value, cast(l_suppkey as varchar) as distributor_code,
  cast(l_suppkey as varchar) as site_code, outlet_code,
  case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end as channel, banded, available as gift_price_available,
  'VN' as country, cast(floor(tk / 10000) as integer) as year_id, cast(floor(tk / 100) as integer) as month_id, tk as time_key
from daily left join customer on lpad(cast(c_custkey as varchar), 10, '0') = outlet_code""",
    "monthly_promotions_full": f"""
{_FACTS}, {AVG}, {CODED}, {_OUTLET}, {_MONTHS}
select cast(l_suppkey as varchar) as distributor_code, cast(l_suppkey as varchar) as site_code, m.outlet_code,
  coalesce(product_code, 'NA') as product_code, o.channel, coalesce(region, 'NA') as region, coalesce(spg, 'NA') as standard_product_group_code,
  banded, ptype as promotion_type, mech as promotion_mechanism, promotion_id, holder as budget_holder_group, invoice_type,
  case when banded = 'Banded' then 1 else 0 end as banded_code, coalesce(perfect, 0) as perfect_store_status_code,
  coalesce(channel_code, 0) as channel_code, 0 as region_code, cast(coalesce(size_code, 0) as varchar) as store_size_code,
  available as gift_price_available, cast(round(value) as bigint) as promotion_value, cast(round(occ) as bigint) as tot_occdis,
  cast(round(per) as bigint) as tot_perstr, cast(round(dis) as bigint) as tot_display, cast(round(lty) as bigint) as tot_ltyprg,
  {_flag('occ > 0')} as has_occdis, {_flag('per > 0')} as has_perstr, {_flag('occ > 0 and per > 0')} as has_occdis_and_perstr,
  {_flag('occ > 0 or per > 0')} as has_occdis_or_perstr, cast(floor(mid / 100) as integer) as year_id, mid as month_id, time_key
from marked m left join outlet_codes o on o.outlet_code = m.outlet_code left join site_regions r on r.s_suppkey = m.l_suppkey""",
}
