"""Records of files in parallel against Python's csv module."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from cashweave.sources import feeds, quoted, records

CELLS = ["a", "", '12" pipe', '"x, y"', '"say ""hi"""', 'b"c"', '"q"r"', '"q" r', '"x" ', 'a""b', '"a"b""c', " ", '"end"" "', '""', "\\", '"a\\"']
BROKEN = ['"two\nlines"', '"\n\n"', '"cr\r\nlf"', '"cr\ronly"', '"' + "long\n" * 400 + '"', '"\n""\n,"']


@pytest.fixture
def splits_of(spark):
    """Splits of so many bytes."""
    keep = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keep}

    def set_to(size):
        spark.conf.set(keep[0], str(size))
        spark.conf.set(keep[1], "0")

    yield set_to
    for k, v in before.items():
        spark.conf.set(k, v)


def _write(path, rows, end="\n", bom=False, last=True):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as out:
        out.write(end.join(rows) + (end if last else ""))
    with open(path, newline="", encoding="utf-8-sig") as back:
        return [tuple(r) for r in csv.reader(back)]


def _read(spark, path):
    lines = quoted.lines_of(spark, path)
    layout = quoted.layout_of(lines)
    found = quoted.records(lines, layout).select("*", quoted.cells_of(F.col("record")).alias("cells"))
    got = found.orderBy(*quoted.PLACE).collect()
    return [tuple(r["cells"]) if r["record"] else () for r in got], layout


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("often", [0.0, 0.02, 1.0])
def test_files_equal_the_csv_module(spark, tmp_path, splits_of, end, often):
    """All kinds of cells and line ends, several files, splits that begin and end within records."""
    splits_of(900)
    dice = random.Random(f"{end}{often}")
    weights = [5] * len(CELLS) + [often] * len(BROKEN)
    wanted = []
    for i in range(3):
        rows = [",".join(dice.choices(CELLS + BROKEN, weights, k=dice.randint(1, 4))) for _ in range(150)]
        wanted += _write(tmp_path / f"a {i}%20.csv", rows, end, bom=i == 1, last=i != 2)
    got, layout = _read(spark, str(tmp_path))
    assert got == wanted
    assert layout.plain == (often == 0)
    assert len(layout.splits) > 5 or end == "\r"


def test_one_line_break_costs_one_split(spark, tmp_path, splits_of):
    """As many tasks with a line break in a cell as without; only its split is put in order."""
    splits_of(2_000)
    rows = [f"row {i},{'x' * 40}" for i in range(1_000)]
    _write(tmp_path / "plain.csv", rows)
    wanted = _write(tmp_path / "broken.csv", [*rows[:500], '"row\n500",' + "x" * 38, *rows[501:]])
    plain, broken = (quoted.lines_of(spark, str(tmp_path / f"{n}.csv")) for n in ("plain", "broken"))
    assert plain.rdd.getNumPartitions() == broken.rdd.getNumPartitions() > 10
    layout = quoted.layout_of(broken)
    assert sum(not s.plain for s in layout.splits) in (1, 2)
    assert _read(spark, str(tmp_path / "broken.csv"))[0] == wanted


def test_record_over_many_splits(spark, tmp_path, splits_of):
    splits_of(300)
    wanted = _write(tmp_path / "a.csv", ["h,i", '1,"' + "part\n" * 1_000 + '"', "2,x", '"\n"' + ",3", "4,5"])
    got, layout = _read(spark, str(tmp_path / "a.csv"))
    assert got == wanted and sum(s.enters for s in layout.splits) > 10


def test_a_quote_open_at_the_end(spark, tmp_path):
    _write(tmp_path / "a.csv", ["a,b", '1,"2'])
    _write(tmp_path / "b.csv", ["a,b", "1,2"])
    with pytest.raises(ValueError, match="still open.*a.csv"):
        quoted.layout_of(quoted.lines_of(spark, str(tmp_path)))


SALES = feeds.REPMT_SALES
HEADS = ["merchant,sku,total inflow,proceeds,l2e", '"sku","Merchant\r\nName",proceeds,"total\ninflow",l2e,more']


def test_many_files_are_one_scan(spark, tmp_path):
    """200 files with two forms of headers, one over several lines, and line breaks in cells."""
    wanted = []
    for i in range(200):
        row = [f'm {i}\n"x"', f"S{i}", str(i), f"{i}.5", ""]
        order = row if i % 3 else [row[1], row[0], row[3], row[2], row[4], "z"]
        with open(tmp_path / f"{i}.csv", "w", newline="") as out:
            out.write(HEADS[0 if i % 3 else 1] + "\n")
            csv.writer(out).writerow(order)
        wanted.append((row[0], row[1], row[2], row[3], None))
    (tmp_path / "empty.csv").write_text("")
    table = feeds.opened(spark, str(tmp_path))
    assert len(table.forms) == 2
    df = feeds.feed_rows(table, SALES)
    assert sorted(tuple(r) for r in df.collect()) == sorted(wanted)
    plain = feeds.read_feed(spark, f"{tmp_path}/[1-2].csv", SALES)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Scan text") == 2
    with pytest.raises(ValueError, match="missing columns"):
        feeds.read_feed(spark, str(tmp_path), feeds.VA_TXN)


def test_plain_files_need_no_shuffle(spark, tmp_path):
    for i in range(3):
        _write(tmp_path / f"{i}.csv", [HEADS[0], f"m,S{i},1,2,3"])
    df = feeds.read_feed(spark, str(tmp_path), SALES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1 and "Exchange" not in plan
    assert sorted(r["sku_id"] for r in df.collect()) == ["S0", "S1", "S2"]


def test_blank_lines_and_short_rows(spark, tmp_path):
    _write(tmp_path / "a.csv", ["", HEADS[0], "", "m,S1", "m,S2,1,2,3,4,5", ""])
    found = feeds.read_feed(spark, str(tmp_path / "a.csv"), SALES)
    assert sorted(tuple(r) for r in found.collect()) == [("m", "S1", None, None, None), ("m", "S2", "1", "2", "3")]


def test_lines_of_a_table(spark):
    """Lines with a place of their own, in any order, over several blocks."""
    text = ["x,y", '"a', '""b""', 'c",1', "", 'd,"', "", '"', "e,2"]
    rows = [(i // 4, i, t) for i, t in enumerate(text)]
    dealt = spark.createDataFrame(rows, "block long, line_no long, line string").repartition(5, "line")
    found = records.records_of(dealt).orderBy("block", "line_no").collect()
    assert [(r["line_no"], r["record"]) for r in found] == [(0, "x,y"), (1, '"a\n""b""\nc",1'), (4, ""), (5, 'd,"\n\n"'), (8, "e,2")]
