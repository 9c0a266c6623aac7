from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promoledger.operators import dims, io_master, monthly, promo

from .conftest import rowset

DIM = [("PERSTR", "OFF"), ("OCCDIS", "OFF"), ("LTYPRG", "ON"), ("DTRDIS", "ON"), ("BASKET", "ON"), ("BASKET", "OFF")]
LINE = (
    "invoice_no string, product_code string, promotion_id string, IO string, promotion_mechanism string, "
    "promotion_type string, outlet_code string, site_code string, on_off_flag int, value_based_promo_disc double, "
    "header_lvl_disc double, free_quantity_value double, promotion_value double, free_qty_in_cs double, free_qty_in_pc double, "
    "year_id int, month_id int, time_key int"
)
WHEN = (2020, 202001, 20200110)


def line(invoice, product, mech, kind, value, outlet="O1", io="0000000001", vbd=None, cs=0.0, pc=0.0):
    flag = 0 if mech in ("FQ", "JR", "NU") else 1
    fund = f"{mech}{io[2:]}"
    return (invoice, product, fund + "X", fund, mech, kind, outlet, "S1", flag, value if vbd is None else vbd, 0.0, 0.0, value, cs, pc, *WHEN)


@pytest.fixture(scope="module")
def world(spark):
    io_raw = [
        ("00000001", "H1", "LN", "B1", 60.0),
        ("00000001", "H1", "LN", "B2", 20.0),
        ("00000001", "H1", "LN", "B3", 20.0),
        ("00000001", "H2", "FQ", "B1", 100.0),
        ("00000002", "H9", "LN", "B1", 0.0),
    ]
    io_rows = spark.createDataFrame(
        [(p, h, s, b, None, v, v) for p, h, s, b, v in io_raw],
        "promotion_id string, budget_holder string, spend_type string, brand_code string, brand_percentage double, "
        "brand_investment double, investment_amount double",
    )
    holders = spark.createDataFrame([("H1", "Brand"), ("H2", "Trade")], "budget_holder string, budget_holder_grp string")
    local = spark.createDataFrame(
        [("P1", "B1", "Tea", "one"), ("P2", "B2", "Tea", "two"), ("P3", "B3", "Oral", "three"), ("P4", "B1", "Tea", "Not Assigned")],
        "product_code string, PH7_code string, category string, dp_name string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("PH9_code", "PH9_description", "division")})
    article = spark.createDataFrame(
        [("P1", "SOAP (1+A)", "B1"), ("P2", "SOAP", "B2"), ("P3", "PASTE", "B3")],
        "material_code string, material_desc string, PH7_code string",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("PH3_description", "PH4_description", "PH5_description", "PH7_description", "PH8_description")}
    )
    hierarchy = dims.standard_hierarchy(local, article)
    io = io_master.io_proportions(io_rows, holders, dims.brand_categories(local))
    return {
        "io": io,
        "hierarchy": hierarchy,
        "brands": promo.io_brands(io, hierarchy),
        "dim": spark.createDataFrame(DIM, "promotion_type string, promo_invoice string"),
        "bridge": spark.createDataFrame([("O1", "PRO"), ("O2", "NA")], "outlet_code string, channel string"),
    }


def test_hierarchy(world):
    assert rowset(world["hierarchy"], "product_code", "brand_code", "standard_product_group_code", "banded") == [
        ("P1", "B1", "P1", "Banded"),
        ("P2", "B2", "P2", "Non-Banded"),
        ("P3", "B3", "P3", "Non-Banded"),
    ]


def test_io_proportions(world):
    got = rowset(world["io"], "IO", "brand_code", "category", "budget_holder_grp", "proportion_PERSTR", "proportion")
    assert got == [
        ("FQ00000001", "B1", "Tea", "Trade", 1.0, 1.0),
        ("LN00000001", "B1", "Tea", "Brand", 0.75, 0.6),
        ("LN00000001", "B2", "Tea", "Brand", 0.25, 0.2),
        ("LN00000001", "B3", "Oral", "Brand", 1.0, 0.2),
        ("LN00000002", "B1", "Tea", None, 0.0, 0.0),
    ]


def test_category_share(spark):
    split = spark.createDataFrame(
        [("2020", "Quarter 1", "Pro", 3.0, 1.0), ("2020", "Quarter 1", "Mom", 0.0, 0.0), ("2020", "Quarter 2", "Pro", 9.0, 9.0)],
        "year string, quarter string, channel string, Tea double, Oral double",
    )
    got = rowset(io_master.category_share(split, "2020", "Quarter 1", ["Tea", "Oral"]), "channel", "category", "percent")
    assert got == [("MOM", "ORAL", 0.0), ("MOM", "TEA", 0.0), ("PRO", "ORAL", 0.25), ("PRO", "TEA", 0.75)]


def test_on_invoice(spark, world):
    lines = spark.createDataFrame(
        [line("I1", "P1", "LN", "LTYPRG", 10.0), line("I2", "P9", "LN", "LTYPRG", 10.0), line("I3", "P2", "XX", "DTRDIS", 5.0),
         line("I4", "P1", "LN", "PERSTR", 7.0), line("I5", "P1", "FQ", "LTYPRG", 7.0)],
        LINE,
    )
    on = promo.on_invoice(lines, world["dim"], world["hierarchy"], world["io"])
    assert rowset(on, "invoice_no", "budget_holder_group", "banded", "invoice_type", "promotion_value") == [
        ("I1", "Brand", "Banded", "ON", 10.0),
        ("I3", "Distributor", "Non-Banded", "ON", 5.0),
    ]


def test_off_invoice_allocation_conserves_value(spark, world):
    lines = spark.createDataFrame(
        [line("I1", "P1", "LN", "PERSTR", 100.0), line("I2", "P1", "LN", "OCCDIS", 50.0, outlet="O2"),
         line("I3", "P1", "ZZ", "OCCDIS", 8.0)],
        LINE,
    )
    share = spark.createDataFrame([("PRO", "TEA", 0.8), ("PRO", "ORAL", 0.2)], "channel string, category string, percent double")
    off = promo.off_invoice_lines(lines, world["dim"], world["bridge"])
    perstr = promo.off_invoice_perstr(off, share, world["brands"])
    assert [(b, round(v, 9)) for b, v in rowset(perstr, "brand_IO", "promotion_value")] == [("B1", 60.0), ("B2", 20.0), ("B3", 20.0)]
    other = promo.off_invoice_other(off, world["brands"])
    got = [(i, b, g, round(v, 9), round(d, 9)) for i, b, g, v, d in rowset(
        other, "invoice_no", "brand_IO", "budget_holder_group", "promotion_value", "value_based_promo_disc")]
    assert got == [
        ("I2", "B1", "Brand", 30.0, 30.0),
        ("I2", "B2", "Brand", 10.0, 10.0),
        ("I2", "B3", "Brand", 10.0, 10.0),
        # No funding order: the value leaks, the component keeps its original amount.
        ("I3", "NA", "Trade Category", 0.0, 8.0),
    ]


def test_summing_before_allocation_changes_nothing(spark, world):
    lines = spark.createDataFrame([line(f"I{n}", "P1", "LN", "OCCDIS", float(n)) for n in range(1, 20)], LINE)
    off = promo.off_invoice_lines(lines, world["dim"], world["bridge"])
    late = promo.off_invoice_other(off, world["brands"]).groupBy("brand_IO").agg(F.round(F.sum("promotion_value"), 6))
    early = promo.off_invoice_other(
        off.groupBy("IO", "promotion_type").agg(*[F.sum(c).alias(c) for c in promo.VALUES]), world["brands"]
    ).select("brand_IO", F.round("promotion_value", 6))
    assert rowset(late) == rowset(early)


def test_gift_price_tiers(spark, world):
    lines = spark.createDataFrame(
        [line("I1", "G1", "FQ", "BASKET", 0.0, cs=2.0, pc=1.0), line("I2", "G2", "FQ", "BASKET", 0.0, cs=1.0, pc=4.0),
         line("I3", "G3", "FQ", "BASKET", 0.0, cs=1.0, pc=4.0), line("I4", "G1", "JR", "BASKET", 0.0)],
        LINE,
    )
    price = spark.createDataFrame(
        [("00000001", "G1", 3.0), ("00000001", "G1", 5.0), ("00000009", "G1", 99.0), ("00000009", "G2", 7.0)],
        "scheme_id string, item_code string, price_vnd double",
    )
    master = spark.createDataFrame([("G1", 10)], "gift_code string, packing_per_case int")
    gifts = promo.gift_value(lines, world["brands"], price, master)
    assert rowset(gifts, "invoice_no", "gift_price_available", "budget_holder_group", "promotion_value") == [
        ("I1", "Y", "Trade", (2 * 10 + 1) * 5.0),
        ("I2", "Y", "Trade", 4 * 7.0),
        ("I3", "N", "Trade", 0.0),
    ]


def test_daily_union_groups_and_books_on_the_product_group(spark, world):
    lines = spark.createDataFrame(
        [line("I1", "P1", "LN", "LTYPRG", 10.0), line("I1", "P1", "LN", "LTYPRG", 5.0), line("I2", "P3", "LN", "OCCDIS", 50.0),
         line("I2", "P2", "LN", "OCCDIS", 50.0), line("I3", "P1", "JR", "BASKET", 4.0)],
        LINE,
    )
    off = promo.off_invoice_lines(lines, world["dim"], world["bridge"])
    price = spark.createDataFrame([], "scheme_id string, item_code string, price_vnd double")
    master = spark.createDataFrame([], "gift_code string, packing_per_case int")
    daily = promo.daily_promotions(
        promo.on_invoice(lines, world["dim"], world["hierarchy"], world["io"]),
        promo.off_invoice_other(off, world["brands"]),
        promo.gift_value(lines, world["brands"], price, master),
        promo.unprocessed_mechanisms(lines),
    )
    got = [(i, p, t, round(v, 6)) for i, p, t, v in rowset(daily, "invoice_no", "product_code", "invoice_type", "promotion_value")]
    assert got == [
        ("I1", "P1", "ON", 15.0),
        ("I2", "P1", "OFF", 60.0),
        ("I2", "P2", "OFF", 20.0),
        ("I2", "P3", "OFF", 20.0),
        ("I3", "P1", "OFF", 4.0),
    ]


def test_trailing_average_fills_zeros(spark):
    fact = spark.createDataFrame(
        [("O1", 202001, 9.0), ("O1", 201911, 3.0), ("O2", 201912, 6.0), ("O3", 201910, 5.0)],
        "transactional_outlet_code string, month_id int, gross_sales_val_mn double",
    )
    assert rowset(monthly.trailing_avg(fact, [201911, 201912, 202001])) == [("O1", 4.0), ("O2", 2.0)]


def test_indicators_sit_on_one_marker_row(spark):
    rows = spark.createDataFrame(
        [("O1", "P1", "OCCDIS", "LN", "a", 5.0), ("O1", "P1", "PERSTR", "LN", "b", 7.0), ("O1", "P1", "OCCDIS", "LN", "c", 1.0),
         ("O1", "P2", "LTYPRG", "LN", "a", 2.0), ("O2", "P1", "BASKET", "JR", "a", 3.0), ("O3", "P1", "OCCDIS", "LN", "a", 3.0)],
        "outlet_code string, product_code string, promotion_type string, promotion_mechanism string, promotion_id string, promotion_value double",
    ).withColumn("__known", F.when(F.col("outlet_code") != "O3", True))
    got = rowset(
        monthly.with_indicators(rows, "__known"),
        "outlet_code", "product_code", "promotion_id", "promotion_type", "promotion_value", "tot_display", "has_occdis_and_perstr", "tot_ltyprg",
    )
    assert got == [
        ("O1", "P1", "a", "OCCDIS", 5.0, 13.0, 1, 0.0),
        ("O1", "P1", "b", "PERSTR", 7.0, None, None, None),
        ("O1", "P1", "c", "OCCDIS", 1.0, None, None, None),
        ("O1", "P2", "a", "LTYPRG", 2.0, 0.0, 0, 2.0),
        ("O2", "P1", "a", "BASKET", 3.0, None, None, None),
        ("O3", "P1", "a", "OCCDIS", 3.0, None, None, None),
    ]


def test_dealt_lines_are_summed_without_another_shuffle(spark, world):
    from promoledger.session import stage

    lines = [line("I1", "P1", "LN", "OCCDIS", 100.0), line("I1", "P2", "LN", "OCCDIS", 60.0), line("I2", "P1", "LN", "LTYPRG", 7.0), line("I3", "P2", "FQ", "OCCDIS", 0.0, pc=3.0), line("I4", "P2", "JR", "OCCDIS", 4.0)]
    promos = spark.createDataFrame(lines, LINE)
    prices = spark.createDataFrame([("P2", "00000001", 5.0)], "item_code string, scheme_id string, price_vnd double")
    packs = spark.createDataFrame([("P2", 12)], "gift_code string, packing_per_case int")
    brands, _ = stage(world["brands"], "brands")

    def daily(deal):
        keep = promo.dealt if deal else lambda df: df
        return promo.daily_promotions(
            keep(promo.on_invoice(promos, world["dim"], world["hierarchy"], world["io"])),
            promo.off_invoice_other(keep(promo.off_invoice_lines(promos, world["dim"], world["bridge"])), brands),
            promo.gift_value(promos, brands, prices, packs, deal=deal),
            keep(promo.unprocessed_mechanisms(promos)),
        )

    assert rowset(daily(True)) == rowset(daily(False)) and daily(True).count() > 4
    above = daily(True)._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert "Aggregate" in above and "Exchange" not in above


def test_channels_carried_by_lines_equal_those_looked_up(spark):
    columns = "invoice_no string, outlet_code string, promo_start_date string, promo_end_date string"
    daily = spark.createDataFrame([(f"I{i}", o, "01.01.2020", "31.12.2020") for i, o in enumerate(["O1", "O2", "O3", None])], columns)
    bridge = spark.createDataFrame([("O1", "PRO"), ("O2", "A"), ("O2", "B"), (None, "C")], "outlet_code string, channel string")
    carried = promo.typed_daily_promotions(promo.with_outlet_channels(daily, bridge), bridge)
    looked_up = promo.typed_daily_promotions(daily, bridge)
    assert carried.columns == looked_up.columns and rowset(carried) == rowset(looked_up)
    assert rowset(carried, "invoice_number", "channel") == [("I0", "PRO"), ("I1", "A"), ("I1", "B"), ("I2", None), ("I3", None)]


def test_dealt_month_rows_get_their_indicators_without_another_shuffle(spark):
    columns = "invoice_type string, outlet_code string, product_code string, promotion_type string, promotion_mechanism string, promotion_id string, time_key int, promotion_value double"
    daily = spark.createDataFrame([("OFF", f"O{i % 3}", f"P{i % 2}", ["OCCDIS", "PERSTR"][i % 2], "LN", f"X{i % 5}", 20200101 + i, float(i)) for i in range(28)], columns)
    found = monthly.with_indicators(monthly.month_rows(daily, "OFF", deal=True))
    assert rowset(found, *sorted(found.columns)) == rowset(monthly.with_indicators(monthly.month_rows(daily, "OFF")), *sorted(found.columns))
    exchanges = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert exchanges and all("REPARTITION_BY_COL" in x for x in exchanges)


def test_held_lines_of_a_branch_give_the_same_rows(spark, world):
    lines = spark.createDataFrame([line("I1", "P2", "FQ", "OCCDIS", 0.0, pc=3.0), line("I2", "P1", "FQ", "OCCDIS", 0.0, pc=1.0)], LINE)
    prices = spark.createDataFrame([("P2", "00000001", 5.0)], "item_code string, scheme_id string, price_vnd double")
    packs = spark.createDataFrame([("P2", 12)], "gift_code string, packing_per_case int")
    folders = []
    held = promo.gift_value(lines, world["brands"], prices, packs, deal=True, folders=folders)
    plain = promo.gift_value(lines, world["brands"], prices, packs)
    assert len(folders) == 1 and held.columns == plain.columns and rowset(held) == rowset(plain) and held.count() >= 2
    assert any(folders[0].rsplit("/", 1)[1] in name for name in held.inputFiles())


def test_month_rows_dealt_by_what_their_lines_share_are_the_same(spark):
    columns = "invoice_type string, outlet_code string, product_code string, promotion_type string, promotion_mechanism string, promotion_id string, time_key int, promotion_value double"
    daily = spark.createDataFrame([("OFF", f"O{i % 3}" if i % 7 else None, f"P{i % 2}", "OCCDIS", "LN", f"X{i % 5}", 20200101 + i, float(i)) for i in range(28)], columns)
    near = monthly.month_rows(daily, "OFF", near=True)
    assert rowset(near) == rowset(monthly.month_rows(daily, "OFF"))
    plan = monthly.month_rows(daily, "OFF", near=True)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert len(exchanges) == 1 and "REPARTITION_BY_COL" in exchanges[0] and "product_code" not in exchanges[0].split("hashpartitioning")[1].split(")")[0]


def test_off_rows_that_know_their_outlet_are_coded_alike_without_joining_it(spark):
    columns = "invoice_type string, outlet_code string, site_code string, product_code string, banded string, promotion_type string, promotion_mechanism string, promotion_id string, time_key int, promotion_value double"
    rows = [("OFF", o, "S1", f"P{i % 2}", "Banded", ["OCCDIS", "PERSTR"][i % 2], "LN", f"X{i % 2}", 20200101 + i, float(i)) for i, o in enumerate(["O1", "O2", "O3", "O4", None] * 3)]
    daily = spark.createDataFrame(rows, columns)
    bridge = spark.createDataFrame([("O1", "A"), ("O2", "A"), ("O2", "B"), ("O3", "B"), (None, "C")], "outlet_code string, channel string")
    outlets = spark.createDataFrame([("O1", "Y"), ("O1", "N"), ("O2", "N")], "outlet_code string, perfect_store string")
    sizes = spark.createDataFrame([("O1", 1), ("O1", 2), ("O4", 3)], "outlet_code string, store_size_code int")
    sites = spark.createDataFrame([("S1", "NORTH")], "site_code string, dt_region string")
    codes = spark.createDataFrame([("CHANNEL", "A", 7), ("CHANNEL", "B", 8)], "ref_type string, ref_desc string, ref_code int")
    lookups = (outlets, sites, codes, sizes)
    told = promo.opened_channels(monthly.with_outlets(daily, outlets, sizes, bridge))
    found, wanted = monthly.monthly_off(told, *lookups), monthly.monthly_off(daily.join(bridge, "outlet_code", "left"), *lookups)
    assert sorted(found.columns) == sorted(wanted.columns) and rowset(found, *sorted(found.columns)) == rowset(wanted, *sorted(found.columns))
    assert found.count() > 10
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(monthly.monthly_off(told.drop("__known", "__perfect", "__sizes"), *lookups)) > joins(found)
