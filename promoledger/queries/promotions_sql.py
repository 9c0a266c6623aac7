"""SQL counterparts of the promotion queries."""

from promoledger.queries.sales_sql import AVG, CODED, HIER, LN, LO, PT

PR = LO + """,
feed as (
  select lo.*, case when rf = 'A' and ls = 'F' then 'FQ' when rf = 'A' then 'JR' when rf = 'N' then 'BD'
      else 'LN' end as mech,
    case substring(o_orderpriority, 1, 1) when '1' then 'PERSTR' when '2' then 'LTYPRG' when '3' then 'OCCDIS'
      when '4' then 'DTRDIS' else 'BASKET' end as base_type,
    lpad(cast((l_linenumber - 1) % 5 + 1 as varchar), 8, '0') as scheme,
    floor(q / 10) as cs, q - 10 * floor(q / 10) as pc
  from lo),
pr as (
  select feed.*, mech || scheme as io, mech || scheme || '-' || substring(o_orderpriority, 1, 1) as promotion_id,
    case when base_type = 'BASKET' and mech = 'BD' then 'BASKET_BD' else base_type end as ptype,
    case when mech in ('FQ', 'JR') then 0 else 1 end as flag,
    cast(cents * dp as double) as vbd, cast(cents * tp as double) as hld,
    coalesce(case when su = 0 then 0 else cs * p_size * pcents / cast(su as double)
             + pc * pcents / cast(su as double) end, 0) as fqv
  from feed left join pt on pt.product_code = feed.product_code),
promos as (select pr.*, vbd + hld + fqv as value from pr)
"""

BRANDS = """
funds as (
  select m.mech || lpad(cast(fam as varchar), 8, '0') as io, p_brand as brand_code, category,
    case fam when 1 then 'Brand' when 2 then 'Trade Marketing' when 3 then 'Customer' when 4 then 'Brand' end as grp,
    cast(inv as double) as inv
  from (select p_brand, fam, category, sum(pcents) as inv from pt group by 1, 2, 3) b
  cross join (select unnest(['BD', 'FQ', 'JR', 'LN']) as mech) m
  where not (m.mech = 'BD' and fam = 5)),
brands as (
  select f.*, inv / sum(inv) over (partition by io) as prop,
    inv / sum(inv) over (partition by io, category) as prop_cat, h.spg
  from funds f
  left join (select distinct brand_code, standard_product_group_code as spg from hier) h
    on h.brand_code = f.brand_code)
"""

BRIDGE = """
bridge as (
  select lpad(cast(c_custkey as varchar), 10, '0') as outlet_code,
    case c_mktsegment when 'MACHINERY' then 'PROFESSIONAL' when 'BUILDING' then 'BUILDING'
      when 'FURNITURE' then 'FURNITURE' else 'NA' end as channel
  from customer)
"""

SHARE = """
sold as (
  select b.channel, pt.category, sum(lo.cents) as cents
  from lo join pt on pt.p_partkey = lo.l_partkey join bridge b on b.outlet_code = lo.outlet_code
  where b.channel <> 'NA' group by 1, 2),
shares as (
  select channel, upper(category) as cat, cast(cents as double) / sum(cast(cents as double)) over (partition by channel)
    as percent
  from sold)
"""

# Off-invoice lines: on the outlet's channel, on the funding order's brands.
OFF = """
off_lines as (
  select promos.*, b.channel from promos join bridge b on b.outlet_code = promos.outlet_code
  where flag = 1 and ptype in ('PERSTR', 'OCCDIS', 'BASKET_BD'))
"""

FINISH = """
    case when coalesce(vbd * p, 0) = 0 then vbd else vbd * p end as a_vbd,
    case when coalesce(hld * p, 0) = 0 then hld else hld * p end as a_hld,
    case when coalesce(fqv * p, 0) = 0 then fqv else fqv * p end as a_fqv,
    coalesce(value, 0) * p as a_value, coalesce(grp, 'Trade Category') as holder
"""

ALLOCATED = f"""
perstr as (
  select x.*, {FINISH}
  from (select l.*, b.brand_code, b.category as fund_category, b.spg, b.grp,
          coalesce(b.prop_cat, 0) * coalesce(s.percent, 0) as p
        from off_lines l left join shares s on s.channel = l.channel
        left join brands b on b.io = l.io and upper(b.category) = s.cat
        where l.ptype = 'PERSTR') x),
other as (
  select x.*, {FINISH}
  from (select l.*, b.brand_code, b.category as fund_category, b.spg, b.grp, coalesce(b.prop, 0) as p
        from off_lines l left join brands b on b.io = l.io where l.ptype <> 'PERSTR') x)
"""

OFF_SUMS = """
off_sums as (
  select mid, channel, io, ptype, mech, sum(vbd) as vbd, sum(hld) as hld, sum(fqv) as fqv, sum(value) as value
  from off_lines group by 1, 2, 3, 4, 5)
"""


def _off_report(source: str) -> str:
    lines = ALLOCATED.replace("off_lines l", "off_sums l")
    return f"""
with {PR.replace(LO, LO + ',' + HIER)}, {BRANDS}, {BRIDGE}, {SHARE}, {OFF}, {OFF_SUMS}, {lines}
select mid as month_id, io as "IO", ptype as promotion_type, coalesce(brand_code, 'NA') as "brand_IO",
  coalesce(fund_category, 'NA') as "category_IO", spg as standard_product_group_code, holder as budget_holder_group,
  count(*) as row_count, cast(sum(cast(round(a_vbd) as bigint)) as bigint) as value_based_promo_disc,
  cast(sum(cast(round(a_hld) as bigint)) as bigint) as header_lvl_disc,
  cast(sum(cast(round(a_fqv) as bigint)) as bigint) as free_quantity_value,
  cast(sum(cast(round(a_value) as bigint)) as bigint) as promotion_value
from {source} group by 1, 2, 3, 4, 5, 6, 7"""


PROMOS = PR.replace(LO, LO + "," + HIER)

ON = """
on_rows as (
  select p.*, h.standard_product_group_code as spg, h.banded,
    coalesce(g.grp, case when ptype = 'DTRDIS' then 'Distributor' else 'Trade Category' end) as holder
  from promos p join hier h on h.product_code = p.product_code
  left join (select distinct io, grp from brands) g on g.io = p.io
  where flag = 1 and ptype in ('LTYPRG', 'DTRDIS', 'BASKET'))
"""

GIFT = """
prices as (
  select lpad(cast((l_linenumber - 1) % 5 + 1 as varchar), 8, '0') as scheme,
    lpad(cast(l_partkey as varchar), 8, '0') as product_code, floor(cents / q) as price
  from ln where tk < 19951001),
gift_rows as (
  select p.*, b.spg, coalesce(b.grp, 'Trade Category') as holder,
    case when coalesce(sp.price, ip.price) is null then 'N' else 'Y' end as available,
    (cs * coalesce(pk.p_size, 0) + pc) * coalesce(sp.price, ip.price, 0) * coalesce(b.prop, 0) as a_value
  from promos p left join brands b on b.io = p.io
  left join (select product_code, scheme, max(price) as price from prices group by 1, 2) sp
    on sp.product_code = p.product_code and sp.scheme = p.scheme
  left join (select product_code, max(price) as price from prices group by 1) ip on ip.product_code = p.product_code
  left join (select product_code, p_size from pt where p_size > 5) pk on pk.product_code = p.product_code
  where flag = 0 and mech not in ('JR', 'NU'))
"""

SUMS = """count(*) as row_count,
  cast(sum(cast(round(vbd) as bigint)) as bigint) as value_based_promo_disc,
  cast(sum(cast(round(hld) as bigint)) as bigint) as header_lvl_disc,
  cast(sum(cast(round(fqv) as bigint)) as bigint) as free_quantity_value,
  cast(sum(cast(round(value) as bigint)) as bigint) as promotion_value"""

DAILY = f"""
branch_rows as (
  select l_orderkey, product_code, spg, promotion_id, io, mech, ptype, holder, 'ON' as invoice_type, l_suppkey,
    outlet_code, banded, 'NA' as available, tk, vbd, hld, fqv, value from on_rows
  union all
  select l_orderkey, spg, spg, promotion_id, io, mech, ptype, holder, 'OFF', l_suppkey, outlet_code, 'Non-Banded', 'NA',
    tk, a_vbd, a_hld, a_fqv, a_value from perstr
  union all
  select l_orderkey, spg, spg, promotion_id, io, mech, ptype, holder, 'OFF', l_suppkey, outlet_code, 'Non-Banded', 'NA',
    tk, a_vbd, a_hld, a_fqv, a_value from other
  union all
  select l_orderkey, spg, spg, promotion_id, io, mech, ptype, holder, 'OFF', l_suppkey, outlet_code, 'Non-Banded',
    available, tk, vbd, hld, fqv, a_value from gift_rows
  union all
  select l_orderkey, product_code, 'NA', promotion_id, io, mech, ptype, 'NA', 'OFF', l_suppkey, outlet_code,
    'Non-Banded', 'NA', tk, vbd, hld, fqv, value from promos where flag = 0 and mech <> 'FQ'),
daily as (
  select l_orderkey, product_code, spg, promotion_id, io, mech, ptype, holder, invoice_type, l_suppkey, outlet_code,
    banded, available, tk, sum(vbd) as vbd, sum(hld) as hld, sum(fqv) as fqv, sum(value) as value
  from branch_rows group by all)
"""

MONTH_CODES = """
left join nation on n_nationkey = s_nationkey
left join region on r_regionkey = n_regionkey"""

SQL = {
    "feed_distinct_clean": f"""
with {LN}
select distinct case when ls = 'O' then 'vn' else 'VN' end as country, tk as time_key,
  cast(l_suppkey as varchar) as site_code, cast(l_orderkey as varchar) as invoice_no,
  cast(l_linenumber as varchar) as billing_item, lpad(cast(l_partkey as varchar), 8, '0') as product_code,
  'LN' as promotion_mechanism, rf as promotion_type, case when rf = 'R' then -cents else cents end as value_cents,
  cast(q as bigint) as free_qty_in_cs, cast(0 as bigint) as header_lvl_disc
from ln where l_suppkey in (select s_suppkey from supplier where s_acctbal >= 0)""",
    "harmonize_value": f"""
with {PROMOS}
select ptype as promotion_type, mech as promotion_mechanism, cast(flag as integer) as on_off_flag, yid as year_id, {SUMS}
from promos group by 1, 2, 3, 4""",
    "loyalty_dedupe": f"""
with {PROMOS},
lty as (
  select *, row_number() over (partition by l_orderkey, io
      order by product_code, cast(l_linenumber as varchar), promotion_id, tk, l_suppkey, outlet_code, mech) as rn
  from promos where ptype = 'LTYPRG'),
firsts as (
  select l_orderkey, io, vbd, hld, fqv, value
  from (select l_orderkey, io, product_code, sum(vbd) as vbd, sum(hld) as hld, sum(fqv) as fqv, sum(value) as value,
          row_number() over (partition by l_orderkey, io order by product_code) as pn
        from lty group by 1, 2, 3)
  where pn = 1)
select 'LTYPRG' as promotion_type, cast(t.l_orderkey as varchar) as invoice_no, t.io as "IO", product_code,
  cast(l_linenumber as varchar) as billing_item, promotion_id, tk as time_key,
  cast(round(sum(case when rn = 1 then f.vbd else 0 end)) as bigint) as value_based_promo_disc,
  cast(round(sum(case when rn = 1 then f.hld else 0 end)) as bigint) as header_lvl_disc,
  cast(round(sum(case when rn = 1 then f.fqv else 0 end)) as bigint) as free_quantity_value,
  cast(round(sum(case when rn = 1 then f.value else 0 end)) as bigint) as promotion_value,
  cast(sum(cs) as bigint) as free_qty_in_cs, cast(sum(pc) as bigint) as free_qty_in_pc
from lty t left join firsts f on f.l_orderkey = t.l_orderkey and f.io = t.io
group by t.l_orderkey, t.io, product_code, l_linenumber, promotion_id, tk, l_suppkey, outlet_code, mech
union all
select ptype, cast(l_orderkey as varchar), io, product_code, cast(l_linenumber as varchar), promotion_id, tk, cast(round(vbd) as bigint),
  cast(round(hld) as bigint), cast(round(fqv) as bigint), cast(round(value) as bigint), cast(cs as bigint), cast(pc as bigint)
from promos where ptype <> 'LTYPRG'""",
    "bridge_channel": f"""
with {BRIDGE}
select channel, count(*) as outlets from bridge group by 1""",
    "std_hierarchy": f"""
with {HIER}
select product_code, product_desc, dp_name, brand_code, standard_product_group_code, category, division,
  master_market, lead_basepack_code, banded
from hier""",
    "latest_io_rank": """
select promotion_id, brand_code, budget_holder, brand_investment
from (
  select cast(o_custkey as varchar) as promotion_id, cast(o_orderkey as varchar) as brand_code,
    o_orderpriority as budget_holder, cast(round(o_totalprice * 100) as bigint) as brand_investment,
    rank() over (partition by o_custkey order by case when year(o_orderdate) >= 2001 then 2001 else 2000 end desc) as r
  from orders)
where r = 1""",
    "brand_remap": """
select case when p_brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') then 'Brand#1' else p_brand end
    as brand_code, count(*) as row_count,
  cast(sum(cast(round(p_retailprice * 100) as bigint)) as bigint) as brand_investment
from part group by 1""",
    "io_proportions": f"""
with {LO}, {HIER},
inv as (
  select o_orderpriority, p_brand, case when category = 'Category 5' then null else category end as category,
    cast(sum(cents) as bigint) as inv
  from lo join pt on pt.p_partkey = lo.l_partkey group by 1, 2, 3)
select 'IO' || o_orderpriority as "IO", p_brand as brand_code, coalesce(category, 'NA') as category,
  case substring(o_orderpriority, 1, 1) when '1' then 'Brand' when '2' then 'Trade Marketing' when '3' then 'Customer'
    when '4' then 'Brand' end as budget_holder_grp,
  inv as brand_investment, cast(0 as bigint) as brand_percentage,
  cast(case when category is null then 0 else sum(inv) over (partition by o_orderpriority, category) end as bigint)
    as "total_IO_amt_PERSTR",
  cast(sum(inv) over (partition by o_orderpriority) as bigint) as "total_IO_amt",
  round(case when category is null then 0
    else inv / cast(sum(inv) over (partition by o_orderpriority, category) as double) end, 6) as "proportion_PERSTR",
  round(inv / cast(sum(inv) over (partition by o_orderpriority) as double), 6) as proportion
from inv""",
    "category_share_unpivot": f"""
with {LO}, {PT}, {BRIDGE},
cats as (select unnest(['Category 1', 'Category 2', 'Category 3', 'Category 4', 'Category 5']) as category),
sold as (
  select cast(yid as varchar) as year, 'Quarter ' || cast(quarter(l_shipdate) as varchar) as quarter, channel, category,
    sum(cents) as cents
  from lo join pt on pt.p_partkey = lo.l_partkey join bridge b on b.outlet_code = lo.outlet_code
  where channel <> 'NA' group by 1, 2, 3, 4),
grid as (select * from (select distinct year, quarter, channel from sold) cross join cats)
select g.year, g.quarter, g.channel, upper(g.category) as category,
  round(coalesce(cents, 0) / cast(sum(coalesce(cents, 0)) over (partition by g.year, g.quarter, g.channel) as double), 6)
    as percent
from grid g left join sold s on s.year = g.year and s.quarter = g.quarter and s.channel = g.channel
  and s.category = g.category""",
    "on_invoice": f"""
with {PROMOS}, {BRANDS}, {ON}
select ptype as promotion_type, mech as promotion_mechanism, holder as budget_holder_group,
  spg as standard_product_group_code, banded, 'ON' as invoice_type, {SUMS}
from on_rows group by 1, 2, 3, 4, 5""",
    "off_invoice_perstr": _off_report("perstr"),
    "off_invoice_other": _off_report("other"),
    "gift_value": f"""
with {PROMOS}, {BRANDS}, {GIFT}
select yid as year_id, ptype as promotion_type, spg as standard_product_group_code, holder as budget_holder_group,
  available as gift_price_available, {SUMS.replace("round(value)", "round(a_value)")}
from gift_rows group by 1, 2, 3, 4, 5""",
    "daily_promotions": f"""
with {PROMOS}, {BRANDS}, {BRIDGE}, {SHARE}, {OFF}, {ALLOCATED}, {ON}, {GIFT}, {DAILY}
select tk as time_key, invoice_type, ptype as promotion_type, mech as promotion_mechanism,
  available as gift_price_available, {SUMS}
from daily group by 1, 2, 3, 4, 5""",
    "monthly_on": f"""
with {PROMOS}, {BRANDS}, {ON}, {AVG}, {CODED},
month_rows as (
  select cast(strftime(last_day(l_shipdate), '%Y%m%d') as integer) as time_key, l_suppkey, outlet_code, product_code,
    spg, banded, ptype, mech, promotion_id, holder, sum(value) as value
  from on_rows group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)
select m.time_key, r_name as region, cast(coalesce(cc.code, 0) as integer) as channel_code,
  cast(coalesce(s.store_size_code, 0) as integer) as store_size_code,
  case when c_acctbal >= 5000 then 1 else 0 end as perfect_store_status_code,
  case when banded = 'Banded' then 1 else 0 end as banded_code, ptype as promotion_type, 0 as has_occdis,
  count(*) as row_count, cast(sum(cast(round(value) as bigint)) as bigint) as promotion_value,
  cast(0 as bigint) as tot_display
from month_rows m
left join customer c on lpad(cast(c_custkey as varchar), 10, '0') = m.outlet_code
left join coded_channel cc
  on cc.channel = case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end
left join sizes s on s.outlet_code = m.outlet_code
left join supplier on s_suppkey = m.l_suppkey {MONTH_CODES}
group by 1, 2, 3, 4, 5, 6, 7""",
    "monthly_off_indicators": f"""
with {PROMOS}, {BRANDS}, {BRIDGE}, {SHARE}, {OFF}, {ALLOCATED}, {CODED},
off_rows as (
  select l_shipdate, l_suppkey, outlet_code, spg as product_code, spg, ptype, mech, promotion_id, holder, a_value as value
  from perstr
  union all
  select l_shipdate, l_suppkey, outlet_code, spg, spg, ptype, mech, promotion_id, holder, a_value from other
  union all
  select l_shipdate, l_suppkey, outlet_code, product_code, 'NA', ptype, mech, promotion_id, 'NA', value
  from promos where flag = 0 and mech <> 'FQ'),
month_rows as (
  select cast(strftime(last_day(l_shipdate), '%Y%m%d') as integer) as time_key, l_suppkey, outlet_code,
    coalesce(product_code, 'NA') as product_code, spg, ptype, mech, promotion_id, holder, sum(value) as value
  from off_rows group by 1, 2, 3, 4, 5, 6, 7, 8, 9),
ranked as (
  select *, row_number() over (partition by time_key, outlet_code, product_code
      order by ptype, cast(l_suppkey as varchar), spg nulls first, mech, promotion_id, holder) as rn
  from month_rows),
totals as (
  select time_key, outlet_code, product_code, sum(case when ptype = 'OCCDIS' then value else 0 end) as occ,
    sum(case when ptype = 'PERSTR' then value else 0 end) as per,
    sum(case when ptype in ('OCCDIS', 'PERSTR') then value else 0 end) as dis,
    sum(case when ptype = 'LTYPRG' then value else 0 end) as lty
  from month_rows group by 1, 2, 3)
select r.time_key, ptype as promotion_type, mech as promotion_mechanism,
  cast(coalesce(cc.code, 0) as integer) as channel_code, count(*) as row_count, count(occ) as marker_rows,
  cast(sum(cast(round(value) as bigint)) as bigint) as promotion_value,
  cast(sum(cast(round(occ) as bigint)) as bigint) as tot_occdis,
  cast(sum(cast(round(per) as bigint)) as bigint) as tot_perstr,
  cast(sum(cast(round(dis) as bigint)) as bigint) as tot_display,
  cast(sum(cast(round(lty) as bigint)) as bigint) as tot_ltyprg,
  cast(sum(case when occ > 0 then 1 when occ is not null then 0 end) as bigint) as has_occdis,
  cast(sum(case when per > 0 then 1 when occ is not null then 0 end) as bigint) as has_perstr,
  cast(sum(case when occ > 0 and per > 0 then 1 when occ is not null then 0 end) as bigint) as has_occdis_and_perstr,
  cast(sum(case when occ > 0 or per > 0 then 1 when occ is not null then 0 end) as bigint) as has_occdis_or_perstr
from ranked r
left join totals t on t.time_key = r.time_key and t.outlet_code = r.outlet_code and t.product_code = r.product_code
  and rn = 1 and mech not in ('JR', 'NU')
left join customer c on lpad(cast(c_custkey as varchar), 10, '0') = r.outlet_code
left join coded_channel cc
  on cc.channel = case when c_mktsegment = 'MACHINERY' then 'PROFESSIONAL' else c_mktsegment end
group by 1, 2, 3, 4""",
}
