import gzip

import pytest

from cashweave.sources import feeds
from small import rows

SALES = feeds.REPMT_SALES


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_headers_by_alias_case_and_order(spark, tmp_path):
    path = _write(
        tmp_path / "s.csv",
        '﻿Proceeds,"Merchant-Name",extra,SKU,L2+E,Total  Inflow\r\n'
        '"1,000.50",ABC,z,S1,,5\r\n'
        "2,ABC,z,S2\r\n",
    )
    df = feeds.read_feed(spark, path, SALES)
    assert df.columns == ["merchant", "sku_id", "total_funds_inflow", "sales_proceeds", "l2e"]
    assert rows(df) == [("ABC", "S1", "5", "1,000.50", None), ("ABC", "S2", None, "2", None)]


def test_repeated_headers_last_one_counts(spark, tmp_path):
    path = _write(tmp_path / "s.csv", "merchant,sku,SKU,inflow,Total Inflow,proceeds,l2e\nm,a,b,1,2,3,4\n")
    assert rows(feeds.read_feed(spark, path, SALES)) == [("m", "b", "2", "3", "4")]


def test_aliases_go_before_the_canonical_name():
    where = feeds.resolve_columns(["spar", "SPAR merchant", "merchant name"] + list(feeds.REPMT_SKU.columns[1:16]) + ["platform fee"], feeds.REPMT_SKU)
    assert (where["merchant"], where["spar_merchant"]) == (2, 1)
    only = feeds.resolve_columns(["spar merchant"] + list(feeds.REPMT_SKU.columns[1:]), feeds.REPMT_SKU)
    assert only["merchant"] == 0 or only["merchant"] == 16


def test_missing_columns_are_all_named(spark, tmp_path):
    path = _write(tmp_path / "s.csv", "merchant,other\nm,1\n")
    with pytest.raises(ValueError, match="sku_id.*total_funds_inflow.*found.*other"):
        feeds.read_feed(spark, path, SALES)


def test_quoted_newlines_and_quotes(spark, tmp_path):
    body = 'merchant,sku,total inflow,proceeds,l2e\n"A ""B""\nC",S1,1,2,3\nD,S2,1,2,3\n'
    path = _write(tmp_path / "s.csv", body)
    assert feeds.has_quoted_newlines(spark, path)
    assert rows(feeds.read_feed(spark, path, SALES), "merchant", "sku_id") == [
        ('A "B"\nC', "S1"),
        ("D", "S2"),
    ]
    flat = _write(tmp_path / "flat.csv", body.replace("\nC", " C"))
    assert not feeds.has_quoted_newlines(spark, flat)
    assert feeds.read_feed(spark, flat, SALES).first()["merchant"] == 'A "B" C'


def test_canonicalise_a_frame(spark):
    df = spark.createDataFrame([("m", "s", "1", "2", "3", "x")], "`Merchant` string, `Note ID` string, `Funds Inflow` string, `Sales Proceed` string, `l2_e` string, y string")
    assert rows(feeds.canonicalise(df, SALES), "sku_id", "l2e") == [("s", "3")]


def test_preview(spark, tmp_path):
    path = _write(tmp_path / "s.csv", "Merchant Name,L2+E\n")
    assert rows(feeds.preview_headers(spark, path)) == [(0, "Merchant Name", "merchant name"), (1, "L2+E", "l2 e")]


def test_first_file_by_name(spark, tmp_path):
    for name in ("va_txn_2025-10.csv", "va_txn_2025-09.csv", "va_txn_prepped.csv", "other.csv"):
        _write(tmp_path / name, "x\n")
    where = str(tmp_path)
    assert feeds.find_feed(spark, where, "va_txn_*.csv").endswith("/va_txn_2025-09.csv")
    assert feeds.find_feed(spark, where, "va_txn_*.csv", "other.csv").endswith("/other.csv")
    full = f"{where}/va_txn_2025-10.csv"
    assert feeds.find_feed(spark, where, "va_txn_*.csv", full) == full
    with pytest.raises(FileNotFoundError):
        feeds.find_feed(spark, where, "va_txn_*.csv", "nothing.csv")
    with pytest.raises(FileNotFoundError, match="external_accounts.*repmt_sku.*repmt_sales"):
        feeds.find_feeds(spark, where)


def test_written_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame(
        [('a "q", b', "", None, "line\nbreak"), (" pad ", "2", "\\", "z")], "a string, b string, c string, d string"
    )
    path = str(tmp_path / "out.csv")
    feeds.write_csv(df, path)
    back = feeds.load_columns(spark, path, ["a", "b", "c", "d"])
    assert rows(back) == [(" pad ", "2", "\\", "z"), ('a "q", b', None, None, "line\nbreak")]


def test_loads_by_position_also_gzipped(spark, tmp_path):
    path = tmp_path / "m.csv.gz"
    path.write_bytes(gzip.compress(b"any,header,names\n,S1,V1\n"))
    assert rows(feeds.load_columns(spark, str(path), feeds.MAPPING_COLUMNS)) == [(None, "S1", "V1")]


def test_wrong_number_of_cells_is_an_error(spark, tmp_path):
    path = _write(tmp_path / "m.csv", "a,b,c\n1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.load_columns(spark, path, feeds.MAPPING_COLUMNS).collect()


def test_append_and_replace(spark, tmp_path):
    source = _write(tmp_path / "m.csv", "n,s,v\n,S1,V1\n")
    table = str(tmp_path / "raw")
    for fresh, count in ((True, 1), (False, 2), (False, 3), (True, 1)):
        loaded = feeds.with_load_columns(feeds.load_columns(spark, source, feeds.MAPPING_COLUMNS, source=True))
        feeds.write_raw(loaded, table, fresh)
        df = spark.read.parquet(table)
        assert df.count() == count
    row = df.first()
    assert df.columns[:2] == ["source_file", "load_at"]
    assert row["source_file"].endswith("m.csv") and row["load_at"] is not None


def test_mapping_file_guard(spark, tmp_path):
    assert feeds.load_mapping_file(spark, _write(tmp_path / "a.csv", "note_id,sku_id,va_number\n")) is None
    assert feeds.load_mapping_file(spark, _write(tmp_path / "b.csv", "note_id,sku_id,va_number\n,S,V\n")).count() == 1
    with pytest.raises(FileNotFoundError):
        feeds.load_mapping_file(spark, str(tmp_path / "c.csv"))


def test_feeds_of_several_files(spark, tmp_path):
    """A directory or a glob: every file, each by its own header. A pattern: the first, with a warning."""
    head = "merchant,sku,total inflow,proceeds,l2e\n"
    (tmp_path / "parts").mkdir()
    _write(tmp_path / "parts/a.csv", head + 'm,S1,1,2,12" pipe\nm,S2,1,2,3\n')
    _write(tmp_path / "parts/b.csv", "sku,merchant,proceeds,total inflow,l2e\nS3,m,2,1,3\n")
    for path in (f"{tmp_path}/parts", f"{tmp_path}/parts/*.csv"):
        assert feeds.find_feed(spark, str(tmp_path), "x*", path) == path
        df = feeds.read_feed(spark, path, SALES)
        assert rows(df, "sku_id", "total_funds_inflow", "sales_proceeds") == [("S1", "1", "2"), ("S2", "1", "2"), ("S3", "1", "2")]
    assert not feeds.has_quoted_newlines(spark, f"{tmp_path}/parts/a.csv")
    with pytest.warns(UserWarning, match="b.csv"):
        assert feeds.find_feed(spark, f"{tmp_path}/parts", "*.csv").endswith("a.csv")
    with pytest.raises(FileNotFoundError):
        feeds.find_feed(spark, str(tmp_path), "x*", "nothing/*.csv")


def test_cells_of_a_loaded_record_are_taken_apart_once(spark, tmp_path):
    """The check of their number does not compute them again."""
    path = _write(tmp_path / "m.csv", 'note_id,sku_id,va_number\n"N,1",S,V\n')
    loaded = feeds.load_columns(spark, path, feeds.MAPPING_COLUMNS)
    assert rows(loaded) == [("N,1", "S", "V")]
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
