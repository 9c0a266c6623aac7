from __future__ import annotations

from promoledger import schemas
from promoledger.operators import feed
from promoledger.sources import readers

from .conftest import rowset


def test_report_export_is_cleaned_by_content(spark, tmp_path):
    line = "VN;2019;01;{day};D1;{site};77;INV1;ZF;10;P1;LN00000001X;desc;01.01.2019;31.01.2019;LINDIS;1,234.50-;;1;2;;;;"
    text = ["Report", "", "Filters", "more", "", "Country;Calendar year;Calendar month;Calendar day"]
    text += [line.format(day="28.01.2019", site="3004")] * 2
    text += [line.format(day="28.01.2019", site="9999"), line.format(day="Overall Result", site="3004")]
    text += ["TH" + line.format(day="28.01.2019", site="3004")[2:]]
    for n in (1, 2):
        (tmp_path / f"part {n}.csv").write_text("\n".join(text) + "\n")
    raw = readers.read_report_export(spark, str(tmp_path), schemas.PROMO_FEED)
    sites = spark.createDataFrame([("3004",)], "site_code string")
    cleaned = feed.clean_promo_feed(raw, sites)
    assert rowset(
        cleaned, "time_key", "site_code", "promotion_mechanism", "value_based_promo_disc", "header_lvl_disc", "free_qty_in_pc"
    ) == [(20190128, "3004", "LN", -1234.5, 0.0, 2.0)]


def test_control_totals_lose_their_sign(spark):
    raw = spark.createDataFrame(
        [
            ("28.01.2019", "3004", "DT DISTRIBUTOR", "1,000.5-", "2", None, "3"),
            ("Calendar day", "Site", "Type", "a", "b", "c", "d"),
        ],
        schemas.CONTROL_TOTALS,
    )
    assert rowset(feed.clean_control_totals(raw)) == [(20190128, "3004", 1000.5, 2.0, None, 3.0)]


def _feed(spark, rows):
    return spark.createDataFrame(
        rows,
        "time_key int, outlet_code string, product_code string, promotion_id string, promotion_mechanism string, "
        "promotion_type string, value_based_promo_disc double, header_lvl_disc double, free_qty_in_cs double, "
        "free_qty_in_pc double",
    )


def test_harmonize_values_free_goods(spark):
    article = spark.createDataFrame(
        [("P1", 10.0, 2, 24), ("P0", 10.0, 0, 24)], "material_code string, price_per_su double, PC_per_SU int, PC_per_CS int"
    )
    promos = _feed(
        spark,
        [
            (20190128, "77", "P1", "BD00000001X", "BD", "BASKET", 5.0, None, 1.0, 3.0),
            (20190128, "77", "P0", "FQ00000001X", "FQ", "BASKET", None, 2.0, 1.0, 3.0),
            (20190128, "77", "P9", "LN00000001X", "LN", "LTYPRG", 1.0, 1.0, 1.0, 1.0),
        ],
    )
    got = rowset(
        feed.harmonize_promo(promos, article),
        "product_code", "outlet_code", "IO", "promotion_type", "on_off_flag", "free_quantity_value", "promotion_value",
        "year_id", "month_id",
    )
    assert got == [
        ("P0", "0000000077", "FQ00000001", "BASKET", 0, 0.0, 2.0, 2019, 201901),
        ("P1", "0000000077", "BD00000001", "BASKET_BD", 1, 1 * 24 * 10 / 2 + 3 * 10 / 2, 5 + 135.0, 2019, 201901),
        ("P9", "0000000077", "LN00000001", "LTYPRG", 1, 0.0, 2.0, 2019, 201901),
    ]


def test_loyalty_is_counted_once_per_invoice_and_order(spark):
    columns = (
        "invoice_no string, IO string, product_code string, billing_item string, promotion_id string, "
        "promotion_type string, value_based_promo_disc double, header_lvl_disc double, free_quantity_value double, "
        "promotion_value double, free_qty_in_cs double"
    )
    rows = [
        ("I1", "A", "P2", "1", "A1", "LTYPRG", 9.0, 0.0, 0.0, 9.0, 1.0),
        ("I1", "A", "P1", "2", "A1", "LTYPRG", 4.0, 0.0, 0.0, 4.0, 2.0),
        ("I1", "A", "P1", "3", "A1", "LTYPRG", 5.0, None, 0.0, 5.0, None),
        ("I1", "A", "P1", "3", "A1", "LTYPRG", None, None, None, None, 7.0),
        ("I1", "B", "P7", "4", "B1", "LTYPRG", 3.0, 0.0, 0.0, 3.0, 1.0),
        (None, "B", "P7", "4", "B1", "LTYPRG", 8.0, 0.0, 0.0, 8.0, 1.0),
        ("I1", "A", "P2", "1", "A1", "PERSTR", 9.0, 0.0, 0.0, 9.0, 1.0),
        ("I1", "A", "P2", "1", "A1", None, 9.0, 0.0, 0.0, 9.0, 1.0),
    ]
    got = rowset(
        feed.dedupe_loyalty(spark.createDataFrame(rows, columns)),
        "invoice_no", "IO", "product_code", "billing_item", "promotion_type", "promotion_value", "free_qty_in_cs",
    )
    assert got == [
        (None, "B", "P7", "4", "LTYPRG", 0.0, 1.0),
        ("I1", "A", "P1", "2", "LTYPRG", 9.0, 2.0),
        ("I1", "A", "P1", "3", "LTYPRG", 0.0, 7.0),
        ("I1", "A", "P2", "1", "LTYPRG", 0.0, 1.0),
        ("I1", "A", "P2", "1", "PERSTR", 9.0, 1.0),
        ("I1", "B", "P7", "4", "LTYPRG", 3.0, 1.0),
    ]


def test_loyalty_rows_are_shuffled_once_and_those_without_an_invoice_collapse(spark):
    columns = "promotion_type string, invoice_no string, IO string, product_code string, billing_item string, promotion_id string, value_based_promo_disc double, header_lvl_disc double, free_quantity_value double, promotion_value double, free_qty_in_cs double"
    rows = [("LTYPRG", i, o, p, b, "X", 5.0, 0.0, 0.0, 5.0, 1.0) for i, o, p, b in [("I1", "A", "P1", "1"), ("I1", "A", "P2", "2"), (None, "A", "P1", "1"), (None, "A", "P1", "1"), ("I2", None, "P1", "1")]]
    found = feed.dedupe_loyalty(spark.createDataFrame(rows, columns))
    assert rowset(found, "invoice_no", "IO", "product_code", "promotion_value", "free_qty_in_cs") == [
        (None, "A", "P1", 0.0, 2.0), ("I1", "A", "P1", 5.0, 1.0), ("I1", "A", "P2", 0.0, 1.0), ("I2", None, "P1", 0.0, 1.0),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(invoice_no" in x for x in plan.splitlines() if "REPARTITION" in x) == 2
    assert sum("Exchange" in x for x in plan.splitlines()) == 3
