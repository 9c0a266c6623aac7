from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.operators import quality
from promoledger.plans import promotion_month
from promoledger.sources import readers

from .conftest import rowset
from .test_plans import masters  # noqa: F401

FRAME = "Report\nby;me\n\nfilters\nmore;\n"


def _line(day, value="1", country="VN", fields=24):
    return ";".join(([country, "2020", "01", day, "D1", "S1", "77", "I1", "ZF", "10", "P1", "LN00000001X", "x", "", "", "T", value] + ["0"] * 7)[:fields])


def _write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    header = "Country;Calendar Year" + ";x" * 22
    (folder / name).write_text(FRAME + header + "\n" + "\n".join(lines) + "\nVN;;;Overall Result" + ";1" * 20 + "\n")


def test_every_line_of_every_file_is_accounted(spark, tmp_path):
    _write(tmp_path / "in", "good.csv", [_line("01.01.2020"), _line("02.01.2020", "2", "vn")])
    _write(tmp_path / "in" / "sub", "damaged.csv", [_line("01.01.2020"), _line("03.01.2020", fields=9), _line("04.01.2020") + ";more", _line("31.02.2020"), _line(""), _line("05.01.2020", country="TH")])
    (tmp_path / "in" / "note.txt").write_text("VN;not a report")
    lines = readers.read_promo_files(spark, str(tmp_path / "in"))
    accounts = readers.line_accounts(lines).withColumn("f", F.regexp_extract("source_file", "([^/]+)$", 1))
    # Blank lines are none; a line of another country is none of ours.
    assert rowset(accounts, "f", "n_lines", "n_data", "n_header", "n_total", "n_reject", "n_preamble") == [("damaged.csv", 12, 1, 1, 1, 4, 5), ("good.csv", 8, 2, 1, 1, 0, 4)]
    assert rowset(lines.where("line_kind = 'reject'"), "calendar_day") == [(None,), ("03.01.2020",), ("04.01.2020",), ("31.02.2020",)]
    data = readers.data_lines(lines)
    assert data.columns == schemas.PROMO_FEED.fieldNames() and rowset(data, "calendar_day", "value_based_promo_disc") == [("01.01.2020", "1"), ("01.01.2020", "1"), ("02.01.2020", "2")]
    # Counting kinds alone must not prune the fields that tell a damaged line.
    assert lines.where("line_kind = 'reject'").count() == 4


def test_control_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Title\nCalendar day;Site;Type;a;b;c;d\n01.01.2020;S1;DT X;1,000-;2;3;4\n02.01.2020;S1\n03.01.2020;S2;MT;1;1;1;1\nOverall Result;;;1;1;1;1\n")
    lines = readers.read_control_files(spark, str(tmp_path))
    assert rowset(readers.line_accounts(lines).drop("source_file")) == [(6, 2, 1, 1, 1, 1)]
    assert rowset(readers.control_rows(readers.data_lines(lines)), "site_code") == [("S1",)]


def test_the_month_parses_its_raw_files_once(spark, masters, tmp_path):  # noqa: F811
    paths = promotion_month.PromoPaths(*[str(tmp_path / n) for n in ("processed", "daily", "monthly", "export", "exceptions")])
    _write(tmp_path / "in", "a.csv", [_line("02.01.2020", "100"), _line("03.01.2020", "50")])
    raw = readers.data_lines(readers.read_promo_files(spark, str(tmp_path / "in")))
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    control = spark.createDataFrame([("02.01.2020", "S1", "DT X", "100", "0", "0", "0"), ("03.01.2020", "S1", "DT X", "50", "0", "0", "0")], schemas.CONTROL_TOTALS)
    calendar = spark.createDataFrame([(20200102, 202001, 1)], "time_key int, year_month int, trading_day int")
    promotion_month.ingest(raw.mapInArrow(seen, raw.schema), control, calendar, masters, paths, threshold=5)
    assert reads.value == 2 and spark.read.parquet(paths.processed).count() == 2


def test_rows_lost_on_the_way_stop_the_month(spark, masters, tmp_path, monkeypatch):  # noqa: F811
    paths = promotion_month.PromoPaths(*[str(tmp_path / n) for n in ("processed", "daily", "monthly", "export", "exceptions")])
    _write(tmp_path / "in", "a.csv", [_line("02.01.2020", "100"), _line("03.01.2020", "50")])
    raw = readers.data_lines(readers.read_promo_files(spark, str(tmp_path / "in")))
    real = promotion_month.counted.store_subsets
    monkeypatch.setattr(promotion_month.counted, "store_subsets", lambda df, *a: real(df, *a, prepare=lambda x: x.where("time_key = 20200102")))
    calendar = spark.createDataFrame([(20200102, 202001, 1)], "time_key int, year_month int, trading_day int")
    with pytest.raises(quality.CheckFailed, match="subset_counts"):
        promotion_month.ingest(raw, spark.createDataFrame([], schemas.CONTROL_TOTALS), calendar, masters, paths, threshold=5)


def test_a_large_report_is_written_by_several_tasks(spark, tmp_path):
    from promoledger.queries import controls

    lines = spark.range(0, 40000, 1, 8).select(F.lit(2020).alias("report"), F.lit(8).alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        controls._write_reports(lines, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "out" / "report=2020").glob("*.csv"))) > 1
    assert spark.read.text(str(tmp_path / "out")).agg(F.count_distinct("value")).first()[0] == 40000
