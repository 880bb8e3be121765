import csv
import random
from decimal import Decimal

import pytest

from cashweave.sources import records
from small import rows

HEAD = "SKU ID,Account Number,Merchant,Amount Pulled,Amount Received,Sales Proceeds\n"


def _write(path, text):
    path.write_text(text, encoding="utf-8-sig")
    return str(path)


@pytest.mark.parametrize(
    "text",
    [
        "Report,x\n\n" + HEAD + "S1,V1,M\nS2,V2,M\n\nS3,V3,M\n",
        "Report\n[group]," + HEAD + ",S1,V1\nx,Account Number\n,S2,V2\nTotal of all,9\nS3,V3\n",
        "sku id,va\nS1,V1\n S2 , V2 \nS3,\nS4,V4\n",
        '"a\nb",c\nSKU ID,"Account\nNumber",z\nS1,V1\nS2,V2\ntotals,1\n',
    ],
)
def test_block_ends_at_the_first_stop_row(spark, tmp_path, text):
    pairs = records.extract_block(spark, _write(tmp_path / "r.csv", text))
    # The second case holds a row whose second cell is a heading: it is skipped.
    assert rows(pairs) == [(None, "S1", "V1"), (None, "S2", "V2")]


def test_block_to_the_end_of_the_file(spark, tmp_path):
    text = "SKU ID,A\n" + "".join(f"S{i},V{i}\n" for i in range(500))
    assert records.extract_block(spark, _write(tmp_path / "r.csv", text)).count() == 500


def test_block_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="no 'SKU ID' header"):
        records.extract_block(spark, _write(tmp_path / "a.csv", "x,y\n1,2\n"))
    with pytest.raises(ValueError, match="no product"):
        records.extract_block(spark, _write(tmp_path / "b.csv", "SKU ID,Account\n,,\nS,V\n"))


def test_records_over_many_splits(spark, tmp_path):
    """Records with line breaks, blank lines and several splits of the file."""
    wanted = [f'{i},"cell {i}\nsecond\n\nline {i}",z' if i % 3 == 0 else f"{i},plain" for i in range(400)]
    path = _write(tmp_path / "r.csv", "\n".join(wanted) + "\n")
    keep = {
        "spark.sql.files.maxPartitionBytes": "1500",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        found = records.read_records(spark, path).orderBy("block", "line_no").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r["block"] for r in found}) > 3
    assert [r["record"] for r in found] == wanted


def _splits(spark, size):
    keep = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    return before


@pytest.mark.parametrize("seed", range(4))
def test_records_equal_a_csv_reader(spark, tmp_path, seed):
    """Stray quotes, line breaks in cells, doubled quotes and blank lines, over several splits."""
    dice = random.Random(seed)
    cells = ["a", "", '12" pipe', '"x, y"', '"two\nlines"', '"say ""hi"""', '"\n\n"', 'b"c"', '"q"r"', " ", '"end"" "']
    lines = [",".join(dice.choices(cells, k=dice.randint(1, 4))) for _ in range(300)]
    text = "\n".join(lines) + "\n"
    path = _write(tmp_path / "r.csv", text)
    wanted = list(csv.reader(text.splitlines(keepends=True)))
    before = _splits(spark, 700)
    try:
        found = records.read_records(spark, path).orderBy("block", "line_no").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [next(csv.reader(r["record"].splitlines(keepends=True)), []) for r in found] == wanted


def test_a_stray_quote_loses_no_row(spark, tmp_path):
    path = _write(tmp_path / "r.csv", 'SKU ID,Account\nA,VA-1,12" pipe shop\nB,VA-2,M\nC,VA-3,M\n')
    assert rows(records.extract_block(spark, path), "sku_id") == [("A",), ("B",), ("C",)]
    with pytest.raises(ValueError, match="still open"):
        records.read_records(spark, _write(tmp_path / "o.csv", 'a,"b\nc\n'))


def test_golden_rows(spark, tmp_path):
    text = (
        "SKU ID and Account Number below,,\n" + HEAD
        + 'S2,V2,M,"1,012.485", - ,\n,V9,M,1,1,1\nS1,V1,M,.5,2,3\n'
    )
    golden = records.golden_level1(spark, _write(tmp_path / "g.csv", text))
    assert rows(golden) == [
        ("S1", "V1", "M", Decimal("0.50"), Decimal("2.00"), Decimal("3.00")),
        ("S2", "V2", "M", Decimal("1012.49"), Decimal("0.00"), Decimal("0.00")),
    ]
    ordered = records.golden_in_order(golden)
    assert ordered.columns == HEAD.strip().split(",")
    assert [r["SKU ID"] for r in ordered.collect()] == ["S1", "S2"]
    assert records.level1_amounts_export(golden).collect() == ordered.collect()


def test_golden_rows_agree_with_a_csv_reader(spark, tmp_path):
    lines = [["t"], HEAD.strip().split(",")] + [
        [f"S {i}", f"{i:04}", 'M "x", y', f"{i * 1000:,}.25", "-", str(i)] for i in range(50)
    ]
    path = tmp_path / "g.csv"
    with path.open("w", newline="") as out:
        csv.writer(out).writerows(lines)
    found = rows(records.golden_level1(spark, str(path)))
    assert found == sorted(
        (f"S {i}", f"{i:04}", 'M "x", y', Decimal(f"{i * 1000}.25"), Decimal(0), Decimal(i))
        for i in range(50)
    )


def test_reference_export_fallbacks(spark, tmp_path):
    where = str(tmp_path)

    def found(explicit=None):
        return records.find_reference_export(spark, where, explicit).rpartition("/")[2]

    with pytest.raises(FileNotFoundError):
        found()
    for name in ("my Formula and OUTPUT.csv", "z formula output.csv", "a formula output_1.csv", "formula.csv"):
        _write(tmp_path / name, "x\n")
    assert found() == "a formula output_1.csv"
    _write(tmp_path / "Sample Files((1) Formula & Output).csv", "x\n")
    assert found() == "Sample Files((1) Formula & Output).csv"
    _write(tmp_path / "level1_formula.csv", "x\n")
    assert found(f"{where}/missing.csv") == "level1_formula.csv"
    assert found(f"{where}/formula.csv") == "formula.csv"
