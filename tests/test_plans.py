from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.operators import coded_dims, quality
from promoledger.plans import daily_sales, monthly_sales, personal_data, promotion_month, reference_data

from .conftest import rowset


def _raw(spark, rows):
    """(invoice, article, reference, yyyymmdd, gross)"""
    data = [
        dict(
            CountryCode="VN", ArticleCode=a.rjust(18, "0"), InvoiceNumber=i, SiteCode="S1", DistributorCode="D1", OutletCode="0000000001",
            SalesmanCode="SM", InvoiceType="ZF", SalesReturnReferenceInvoiceNumber=r, InvoiceDate=d and f"{d[:4]}-{d[4:6]}-{d[6:]}",
            GrossSalesValue=g, SalesPCQuantity="2", YYYY=d and d[:4], MM=d and d[4:6], DD=d and d[6:],
        )
        for i, a, r, d, g in rows
    ]
    names = list(data[0])
    text = spark.createDataFrame([tuple(x[n] for n in names) for x in data], ", ".join(f"{n} string" for n in names))
    return schemas.conform(text, schemas.RAW_INVOICE_LINES)


def test_daily_load_reload_and_return(spark, tmp_path):
    paths = daily_sales.SalesPaths(*[str(tmp_path / n) for n in ("processed", "fact", "export")])
    salesman = spark.createDataFrame([("SM", "GT"), ("SM", "GT")], "salesman_code string, salesforce string")
    product = spark.createDataFrame([("00000001", "B", "C", "K")], "product_code string, brand string, category_code string, cotc string")
    stamp = lambda n: F.lit(f"2020-12-0{n} 00:00:00").cast("timestamp")
    first = _raw(spark, [("I1", "1", "0", "20201204", "1.5"), ("I1", "2", "0", "20201204", None)])
    daily_sales.load_day(spark, first, salesman, product, 20201204, paths, batch_ts=stamp(4))
    second = _raw(spark, [("R1", "1", "I1", "20201205", "bad"), ("I2", "1", "0", "20201205", "2")])
    for n in (5, 6):  # the second pass is a reload of the day
        daily_sales.load_day(spark, second, salesman, product, 20201205, paths, batch_ts=stamp(n))
    got = rowset(spark.read.parquet(paths.fact), "invoice_number", "product_code", "gross_sales_val", "brand_cat_core", "salesforce", "time_key")
    assert got == [
        ("I1", "00000001", 150.0, "B_C_K", "GT", 20201204),
        ("I1", "00000002", 0.0, None, "GT", 20201204),
        ("I2", "00000001", 200.0, "B_C_K", "GT", 20201205),
        ("R1", "00000001", 0.0, "B_C_K", "GT", 20201204),
    ]
    assert spark.read.parquet(paths.export).count() == 4


def test_history_load(spark, tmp_path):
    paths = daily_sales.SalesPaths(*[str(tmp_path / n) for n in ("processed", "fact", "export")])
    salesman = spark.createDataFrame([("SM", "GT")], "salesman_code string, salesforce string")
    product = spark.createDataFrame([("00000001", "B", "C", "K")], "product_code string, brand string, category_code string, cotc string")
    raw = _raw(spark, [("I1", "1", "0", "20181204", "1"), ("I2", "1", "0", "20201205", "2")])
    daily_sales.load_history(spark, raw, salesman, product, paths)
    assert rowset(spark.read.parquet(paths.fact), "invoice_number", "year_id", "time_key") == [("I1", 2018, 20181204), ("I2", 2020, 20201205)]
    # A second batch, run twice, leaves the first as it is; its undated line is an offender.
    more = _raw(spark, [("I3", "1", "0", "20190101", "3"), ("I4", "1", "0", None, "4")])
    for _ in range(2):
        daily_sales.load_history(spark, more, salesman, product, paths)
        assert rowset(spark.read.parquet(paths.fact), "invoice_number") == [("I1",), ("I2",), ("I3",)]
        assert spark.read.parquet(paths.processed).count() == 3
        assert spark.read.parquet(f"{paths.fact}-undated").count() == 1


def test_batches_that_share_a_day_keep_each_others_lines(spark, tmp_path, monkeypatch):
    paths = daily_sales.SalesPaths(*[str(tmp_path / n) for n in ("processed", "fact", "export")])
    salesman = spark.createDataFrame([("SM", "GT")], "salesman_code string, salesforce string")
    product = spark.createDataFrame([("00000001", "B", "C", "K")], "product_code string, brand string, category_code string, cotc string")
    load = lambda rows, **more: daily_sales.load_history(spark, _raw(spark, rows), salesman, product, paths, **more)
    one = [("I1", "1", "0", "20200101", "1"), ("I2", "1", "0", "20200102", "2"), ("U1", "1", "0", None, "3")]
    two = [("I3", "1", "0", "20200102", "4"), ("U2", "1", "0", None, "5"), ("U3", "1", "0", None, "5")]
    first = load(one)
    assert load(two) != first and load(list(reversed(one))) == first
    fact = lambda: rowset(spark.read.parquet(paths.fact), "invoice_number", "time_key")
    undated = lambda: rowset(spark.read.parquet(daily_sales.undated_path(paths)), "invoice_number")
    assert fact() == [("I1", 20200101), ("I2", 20200102), ("I3", 20200102)] and undated() == [("U1",), ("U2",), ("U3",)]
    assert spark.read.parquet(paths.processed).count() == 3
    # A named batch that comes again with other lines leaves nothing of what it held.
    load([("N1", "1", "0", "20200102", "1"), ("N2", "1", "0", "20200105", "1"), ("U4", "1", "0", None, "1")], batch_id="n")
    load([("N1", "1", "0", "20200103", "1")], batch_id="n")
    assert fact() == [("I1", 20200101), ("I2", 20200102), ("I3", 20200102), ("N1", 20200103)] and undated() == [("U1",), ("U2",), ("U3",)]
    # A run that breaks off is repaired by the next.
    whole = daily_sales.writers.append_partitions
    monkeypatch.setattr(daily_sales.writers, "append_partitions", lambda df, path, *a: whole(df.filter("invoice_number = 'L1'"), path, *a) or (_ for _ in ()).throw(RuntimeError("lost")))
    late = [("L1", "1", "0", "20200102", "1"), ("L2", "1", "0", "20200102", "1")]
    with pytest.raises(RuntimeError):
        load(late)
    monkeypatch.setattr(daily_sales.writers, "append_partitions", whole)
    load(late)
    assert rowset(spark.read.parquet(paths.processed), "invoice_number") == [("I1",), ("I2",), ("I3",), ("L1",), ("L2",), ("N1",)] and len(fact()) == 6
    # Daily loads go on over the same table.
    daily_sales.load_day(spark, _raw(spark, [("D1", "1", "0", "20200102", "1")]), salesman, product, 20200102, paths)
    # The day was loaded before, so its newest load makes way, as in any reload.
    assert fact() == [("D1", 20200102), ("I1", 20200101), ("I2", 20200102), ("I3", 20200102), ("N1", 20200103)]


def test_a_named_batch_is_not_staged_besides(spark, tmp_path, monkeypatch):
    paths = daily_sales.SalesPaths(*[str(tmp_path / n) for n in ("processed", "fact", "export")])
    salesman = spark.createDataFrame([("SM", "GT"), ("SM", "MT")], "salesman_code string, salesforce string")
    product = spark.createDataFrame([("00000001", "B", "C", "K")], "product_code string, brand string, category_code string, cotc string")
    monkeypatch.setattr(daily_sales.session, "stage", None)
    # Batch one has no line with a date.
    for name, day in (("two", "20200101"), ("one", None), ("two", "20200102")):
        daily_sales.load_history(spark, _raw(spark, [("I1", "1", "0", day, "1"), ("U1", "1", "0", None, "2")]), salesman, product, paths, batch_id=name)
    assert rowset(spark.read.parquet(paths.fact), "invoice_number", "salesforce", "time_key", "batch_id") == [("I1", "GT", 20200102, "two"), ("I1", "MT", 20200102, "two")]
    assert rowset(spark.read.parquet(paths.processed), "invoice_number", "time_key", "batch_id") == [("I1", 20200102, "two")]
    assert rowset(spark.read.parquet(daily_sales.undated_path(paths)), "invoice_number", "batch_id") == [("I1", "one"), ("U1", "one"), ("U1", "two")]


@pytest.fixture(scope="module")
def masters(spark):
    texts = lambda df, *names: df.withColumns({n: F.lit(None).cast("string") for n in names})
    article = texts(
        spark.createDataFrame(
            [("P1", "SOAP (1+A)", 10.0, 1, 2, "B1"), ("P2", "SOAP", 10.0, 1, 2, "B2")],
            "material_code string, material_desc string, price_per_su double, PC_per_SU int, PC_per_CS int, PH7_code string",
        ),
        "PH3_description", "PH4_description", "PH5_description", "PH7_description", "PH8_description",
    )
    local = texts(
        spark.createDataFrame([("P1", "B1", "Tea", "one"), ("P2", "B2", "Oral", "two")], "product_code string, PH7_code string, category string, dp_name string"),
        "PH9_code", "PH9_description", "division",
    )
    channels = spark.createDataFrame([("GROC", "GT"), ("CAFE", "PROFESSIONAL")], "channel string, group_channel string")
    store = spark.createDataFrame([("STORE_SIZE_CLASS", "BIG", 1, 0.0, 1e9)], "ref_type string, ref_desc string, ref_code int, param1 double, param2 double")
    holders = spark.createDataFrame([("H", "Brand")], "budget_holder string, budget_holder_grp string")
    regions = spark.createDataFrame([("NORTH", 4)], "region string, region_code int")
    coded = coded_dims.coded_consolidated(
        coded_dims.coded_channel(channels), coded_dims.coded_region(regions), coded_dims.coded_category(local), coded_dims.coded_budget_holder(holders), store
    )
    io = spark.createDataFrame(
        [("LN00000001", "B1", "Tea", 0.5, 1.0), ("LN00000001", "B2", "Oral", 0.5, 1.0), ("FQ00000001", "B1", "Tea", 1.0, 1.0)],
        "IO string, brand_code string, category string, proportion double, proportion_PERSTR double",
    ).withColumns({"budget_holder": F.lit("H"), "budget_holder_grp": F.lit("Brand")})
    split = spark.createDataFrame([("2020", "Quarter 1", "GROC", *[0.0] * 6, 1.0, 0.0, 3.0)], schemas.PROMOTION_SPLIT)
    return promotion_month.Masters(
        article=article,
        local_product=local,
        outlets=spark.createDataFrame([("0000000077", "GROC", "Y")], "outlet_code string, channel string, perfect_store string"),
        channels=channels,
        channel_map=spark.createDataFrame([("GROC", "GROC")], "channel_org string, channel string"),
        distributors=spark.createDataFrame([("D1", "S1", "VN", "C10000", "NORTH")], "distributor_code string, site_code string, country_code string, distributor_type string, dt_region string"),
        dim_promotion=spark.createDataFrame([("PERSTR", "OFF"), ("OCCDIS", "OFF"), ("LTYPRG", "ON"), ("BASKET", "ON")], "promotion_type string, promo_invoice string"),
        io=io,
        split=split,
        gift_price=spark.createDataFrame([("00000001", "G1", 3.0)], "scheme_id string, item_code string, price_vnd double"),
        gift_master=spark.createDataFrame([("G1", 10)], "gift_code string, packing_per_case int"),
        coded=coded,
    )


def _export(spark, rows):
    data = [
        ("VN", "2020", "01", d, "D1", "S1", "77", i, "ZF", b, p, promo, "desc", "01.01.2020", "31.01.2020", t, v, "0", "1", "1", "0", "0", "0", "0")
        for d, i, b, p, promo, t, v in rows
    ]
    return spark.createDataFrame(data, schemas.PROMO_FEED)


def test_promotion_month_end_to_end(spark, masters, tmp_path):
    paths = promotion_month.PromoPaths(*[str(tmp_path / n) for n in ("processed", "daily", "monthly", "export", "exceptions")])
    raw = _export(
        spark,
        [
            ("02.01.2020", "I1", "10", "P1", "LN00000001X", "LTYPRG", "100"),
            ("02.01.2020", "I1", "20", "P2", "LN00000001X", "LTYPRG", "100"),
            ("03.01.2020", "I2", "10", "P1", "LN00000001X", "PERSTR", "1,000"),
            ("03.01.2020", "I3", "10", "P2", "LN00000001X", "OCCDIS", "40"),
            ("03.01.2020", "I3", "20", "G1", "FQ00000001X", "BASKET", "0"),
            ("03.01.2020", "I4", "10", "P1", "JR00000001X", "BASKET", "6"),
        ],
    )
    control = spark.createDataFrame([("02.01.2020", "S1", "DT X", "200", "0", "2", "2"), ("03.01.2020", "S1", "DT X", "1,046", "0", "4", "4")], schemas.CONTROL_TOTALS)
    calendar = spark.createDataFrame([(20200102, 202001, 1), (20200103, 202001, 1), (20200105, 202001, 0)], "time_key int, year_month int, trading_day int")
    promotion_month.ingest(raw, control, calendar, masters, paths, threshold=5)
    processed = spark.read.parquet(paths.processed)
    assert rowset(processed.filter("promotion_type = 'LTYPRG'"), "product_code", "value_based_promo_disc") == [("P1", 100.0), ("P2", 0.0)]
    promotion_month.transform(spark, masters, paths, 202001, "Quarter 1", threshold=50)
    daily = spark.read.parquet(paths.daily)
    assert daily.columns == schemas.DAILY_PROMOTIONS.fieldNames()
    # PERSTR: 1000 + goods 30 = 1030 over Tea 75% and Oral 25%; OCCDIS 40 + 30 halves; gift (10 + 1) * 3.
    # Categories without a split share leave a row of value 0 without a product group.
    perstr = daily.filter("promotion_type = 'PERSTR' and product_code is not null")
    assert rowset(daily.filter("product_code is null"), "promotion_type", "promotion_value") == [("PERSTR", 0.0)]
    assert [(p, round(v, 6)) for p, v in rowset(perstr, "product_code", "promotion_value")] == [("P1", 772.5), ("P2", 257.5)]
    assert rowset(daily.filter("gift_price_available = 'Y'"), "product_code", "promotion_value") == [("P1", 33.0)]
    assert {r[0] for r in rowset(daily, "channel")} == {"GROC"}
    sales = spark.createDataFrame([("0000000077", 202001, 3.0)], "transactional_outlet_code string, month_id int, gross_sales_val_mn double")
    for _ in range(2):  # a second run reloads the month
        promotion_month.aggregate(spark, sales, masters, paths, 202001, [201911, 201912, 202001])
    monthly = spark.read.parquet(paths.monthly)
    total = lambda df: round(df.agg(F.sum("promotion_value")).first()[0], 6)
    assert total(monthly) == total(daily)
    marked = monthly.filter("tot_display is not null and invoice_type = 'OFF' and product_code = 'P2'")
    assert rowset(marked, "promotion_type", "has_occdis_and_perstr") == [("OCCDIS", 1)]
    assert [round(r[0], 6) for r in rowset(marked, "tot_display")] == [257.5 + 35]
    assert {r[0] for r in rowset(monthly, "time_key")} == {20200131}
    assert {tuple(r) for r in rowset(monthly, "region", "store_size_code", "perfect_store_status_code")} == {("NORTH", "1", 1)}


def test_control_gate_stops_the_month(spark, masters, tmp_path):
    paths = promotion_month.PromoPaths(*[str(tmp_path / n) for n in ("processed", "daily", "monthly", "export", "exceptions")])
    raw = _export(spark, [("02.01.2020", "I1", "10", "P1", "LN00000001X", "LTYPRG", "100")])
    control = spark.createDataFrame([("02.01.2020", "S1", "DT X", "500", "0", "1", "1")], schemas.CONTROL_TOTALS)
    calendar = spark.createDataFrame([(20200102, 202001, 1)], "time_key int, year_month int, trading_day int")
    with pytest.raises(quality.CheckFailed, match="control_totals_breached"):
        promotion_month.ingest(raw, control, calendar, masters, paths, threshold=5)
    assert (tmp_path / "exceptions" / "control_totals").exists()


def test_monthly_sales_rolls_days_up_and_keeps_other_months(spark, masters, tmp_path):
    rows = [("P1", "I1", 20200102, 202001, 5.0), ("P1", "I1", 20200103, 202001, 7.0), ("75X", "I1", 20200103, 202001, 9.0), ("P2", "I2", 20200201, 202002, 1.0)]
    fact = spark.createDataFrame(rows, "product_code string, invoice_number string, time_key int, month_id int, gross_sales_val double").withColumns(
        {"gross_sales_val_mn": F.col("gross_sales_val"), "year_id": F.lit(2020), "transactional_site_code": F.lit("S1"), "transactional_outlet_code": F.lit("0000000077")}
    )
    path = str(tmp_path / "agg")
    for month in (202001, 202002, 202001):
        monthly_sales.load_month(spark, fact, masters, month, path, str(tmp_path / "export"))
    got = rowset(spark.read.parquet(path), "product_code", "time_key", "gross_sales_val", "region", "channel_code", "store_size_code", "perfect_store_status_code", "banded_code")
    assert got == [("P1", 20200131, 12.0, "NORTH", 1, 1, 1, 1), ("P2", 20200229, 1.0, "NORTH", 1, 1, 1, 0)]


def test_coded_axes(spark, masters, tmp_path):
    store = spark.createDataFrame([("STORE_SIZE_CLASS", "BIG", 1, 0.0, 1.0)], "ref_type string, ref_desc string, ref_code int, param1 double, param2 double")
    reference_data.build_dimensions(
        masters.channels.union(spark.createDataFrame([("X", "IC")], "a string, b string")),
        spark.createDataFrame([("NORTH", 4)], "region string, region_code int"),
        masters.local_product,
        spark.createDataFrame([("H", "Brand")], "budget_holder string, budget_holder_grp string"),
        store,
        spark.createDataFrame([("Detailed", "LTYPRG", "1"), ("Other", "Z", "2")], "group string, promo_type string, index string"),
        spark.createDataFrame([("LOYALTY", 2)], "promo_summarized string, summarized_index int"),
        str(tmp_path),
    )
    axis = spark.read.parquet(str(tmp_path / "dim_dynamic_axis"))
    assert axis.count() == 4 * 2 * 3 * 2 * 3
    row = axis.filter("axis_dimension = 'Product Category' and category = 'Tea' and region = 'NORTH' and channel = 'ALL' and store_size_class = 'BIG'").first()
    assert (row.axis_value, row.axis_index, row.category_index, row.region_index, row.channel_index, row.store_size_index) == ("Tea", 32, 32, 4, 100000, 21)
    flexible = spark.read.parquet(str(tmp_path / "dim_promo_flexible"))
    assert rowset(flexible.filter("axis_dimension = 'BUDGET HOLDER'"), "axis_value", "axis_index") == [("Brand", 31), ("Distributor", 32)]
    coded = spark.read.parquet(str(tmp_path / "dim_coded_consolidated"))
    assert rowset(coded.filter("ref_type = 'CHANNEL'"), "ref_desc", "ref_code") == [("GROC", 1), ("PROFESSIONAL", 2)]


def test_io_reference_reads_last_year_in_january(spark, tmp_path):
    columns = schemas.IO_MASTER
    io = lambda rows: schemas.conform(
        spark.createDataFrame(rows, "promotion_id string, spend_type string, brand_code string, budget_holder string, brand_investment double"), columns
    )
    io([("00000001", "LN", "B1", "H", 5.0), ("00000002", "LN", "OLD", "H", 3.0)]).write.parquet(str(tmp_path / "io/2019/12"))
    io([("00000001", "LN", "B1", "H", 1.0), ("00000001", "LN", "B2", "H", 3.0)]).write.parquet(str(tmp_path / "io/2020/01"))
    holders = spark.createDataFrame([("H", "Brand")], "budget_holder string, budget_holder_grp string")
    local = spark.createDataFrame([("B1", "Tea"), ("B2", "Tea")], "PH7_code string, category string")
    brand_map = spark.createDataFrame([("OLD", "B2")], "PH7_old string, PH7_latest string")
    reference_data.build_io_reference(spark, str(tmp_path / "io"), holders, local, str(tmp_path / "out"), 2020, 1, brand_map)
    got = rowset(spark.read.parquet(str(tmp_path / "out/2020/01")), "IO", "brand_code", "proportion")
    assert got == [("LN00000001", "B1", 0.25), ("LN00000001", "B2", 0.75), ("LN00000002", "B2", 1.0)]
    with pytest.raises(quality.CheckStopped):
        reference_data.build_io_reference(
            spark, str(tmp_path / "io"), holders, local, str(tmp_path / "out"), 2020, 1, brand_map.union(brand_map)
        )


def test_masters_are_conformed(spark, tmp_path):
    folder = tmp_path / "in/2020/2/3"
    folder.mkdir(parents=True)
    (folder / "f.csv").write_text("h,g\n01,Brand\n")
    reference_data.conform_master(spark, "budget_holder", str(tmp_path / "in"), str(tmp_path / "out"))
    assert rowset(spark.read.parquet(str(tmp_path / "out"))) == [("01", "Brand")]


def test_salesforce_columns_are_protected(spark, tmp_path):
    names = list(personal_data.SALESFORCE_COLUMNS)
    raw = spark.createDataFrame([tuple(n.lower() for n in names), tuple([None] * len(names))], ", ".join(f"`{n}` string" for n in names))
    key = b"k" * 16
    personal_data.protect(raw, key, str(tmp_path / "csv"), str(tmp_path / "parquet"))
    stored = spark.read.parquet(str(tmp_path / "parquet"))
    assert "role email" not in {r[0] for r in stored.select("email").collect()}
    opened = personal_data.reveal(spark, str(tmp_path / "parquet"), key)
    assert rowset(opened, "role_name", "email", "ship_to_party") == [(None, None, None), ("role name", "role email", "ship-to party")]
