"""CSV records out of lines, read in parallel also where quoted cells hold line breaks.

Cells are those of Python's csv module: a quote opens only at the start of a cell, two
quotes in an open cell are one, and what follows a closing quote belongs to the cell.
A record ends at a line break (LF, CR LF or CR) outside an open cell; within one the
break is kept as it is.

Whether a quote is open at a line depends on all lines before it. Each line is a
function of that state (closed or open before it, to closed or open behind it), and
functions compose: lines within a split of a file, splits within the file. So splits are
looked at in parallel, one short row each goes to the driver, which holds the list of
splits anyway, and is composed there in the order of the files. Then each split is read
knowing how it begins. A split that begins closed and never leaves a line open is read
line by line without a shuffle; of others the lines are put in order within their split
and gathered by record.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_BOM = "﻿"

# What may follow an opening quote up to the end of its cell; a cell; a line of them.
OPEN_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
CELL = rf'(?:"{OPEN_REST}|(?!")[^,]*+)'
CLOSED_LINE = rf"(?s)^{CELL}(?:,{CELL})*+\z"
_CLOSED_AFTER_OPEN = rf"(?s)^{OPEN_REST}(?:,{CELL})*+\z"
_NEXT_CELL = rf"(?s)\G({CELL}),"
_QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)\z'
_LINE_ENDS = "\r\n"

#: So many files or lines are named in an expression, more in a table.
NAMED = 100
#: A place: all of it orders lines.
PLACE = ["file", "block", "line_no"]


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their ends, and their place: file, start of the split, a count.

    The path may name files, directories and globs; all are one scan. The count
    orders the lines of a split and is the same in every job over this frame.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    place = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    # A CR by itself ends a line too.
    apart = F.split(F.col("value"), r"(?<=\r)(?!\z)")
    whole = F.array(F.col("value"))
    lone = F.rtrim("value", F.lit("\r")).contains("\r")
    pieces = place.select("file", "block", F.posexplode(F.when(lone, apart).otherwise(whole)).alias("nth", "value"), lone.alias("lone"), F.size(F.when(lone, apart).otherwise(whole)).alias("n"))
    ended = F.when(F.col("nth") + 1 == F.col("n"), F.concat("value", F.lit("\n"))).otherwise(F.col("value"))
    return pieces.select(
        "file",
        "block",
        F.monotonically_increasing_id().alias("line_no"),
        F.when((F.col("block") == 0) & ended.startswith(_BOM), F.substr(ended, F.lit(2))).otherwise(ended).alias("line"),
    )


def lines_in(source: DataFrame) -> DataFrame:
    """Lines of a table (``block``, ``line_no``, ``line`` without its end) as one file."""
    return source.select(
        F.lit("").alias("file"), "block", "line_no", F.concat("line", F.lit("\n")).alias("line")
    )


def _opens(line: Column) -> Column:
    """Is a quote open behind a line that begins closed?"""
    return line.contains('"') & ~line.rlike(CLOSED_LINE)


class Split(NamedTuple):
    """A split of a file and how it begins: open or closed, and if open, where the record does."""

    file: str
    block: int
    enters: bool
    plain: bool
    start_block: int | None
    start_line: int | None


class Layout(NamedTuple):
    """Splits of all files, in order, and the count of each file's first line."""

    splits: list[Split]
    firsts: dict[str, int]

    @property
    def plain(self) -> bool:
        return all(s.plain for s in self.splits)


def _summaries(lines: DataFrame) -> DataFrame:
    """Per split of a file with open lines, for both states it may begin in: the state
    behind it, and the line where the record begins that is open at its end.

    Lines without effect, such as all without a quote, are left out before the sort.
    """
    opens, stays = _opens(F.col("line")), ~F.col("line").rlike(_CLOSED_AFTER_OPEN)
    effect = lines.where(F.col("line").contains('"')).select(*PLACE, opens.alias("opens"), stays.alias("stays"))
    effect = effect.where(F.col("opens") | ~F.col("stays"))
    marks = effect.select(*PLACE, *_functions())
    both = marks.select("*", *[_open_before(F.lit(s)).alias(f"before_{int(s)}") for s in (False, True)])
    ends, starts = [], []
    for s in (0, 1):
        behind = F.coalesce("fixed", F.col(f"before_{s}") != F.col("turns"))
        ends.append(F.max_by(behind, "line_no").alias(f"behind_{s}"))
        starts.append(F.max(F.when(~F.col(f"before_{s}"), F.col("line_no"))).alias(f"start_{s}"))
    return both.groupBy("file", "block").agg(*ends, *starts)


def _functions() -> list[Column]:
    """A line either fixes the state behind it (``fixed``), or leaves it, or turns it over (``turns``)."""
    same = F.col("opens") == F.col("stays")
    return [F.when(same, F.col("opens")).alias("fixed"), (F.col("opens") & ~F.col("stays")).alias("turns")]


def _open_before(start: Column) -> Column:
    """Is a quote open before this line, if the split begins as ``start``?

    It is the state behind the last line that fixes it, turned over as often as lines
    since then do.
    """
    w = Window.partitionBy("file", "block").orderBy("line_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("turns").cast("long")).over(before), F.lit(0))
    upto = F.sum(F.col("turns").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    fixed = F.last(
        F.when(F.col("fixed").isNotNull(), F.struct("fixed", upto.alias("turned"))), ignorenulls=True
    ).over(before)
    known = F.coalesce(fixed["fixed"], start)
    since = turned - F.coalesce(fixed["turned"], F.lit(0))
    return known != (since % 2 == 1)


def layout_of(lines: DataFrame, name: str = "the lines") -> Layout:
    """How every split of the files begins. One job; a second one over files with open lines.

    Raises ValueError if a quote is still open at the end of a file.
    """
    seen = (
        lines.groupBy("file", "block")
        .agg(F.min("line_no").alias("first"), F.max(_opens(F.col("line"))).alias("opens"))
        .collect()
    )
    seen.sort(key=lambda r: (r["file"], r["block"]))
    firsts: dict[str, int] = {}
    for r in seen:
        firsts.setdefault(r["file"], r["first"])
    open_files = sorted({r["file"] for r in seen if r["opens"]})
    effects = {}
    if open_files:
        effects = {(r["file"], r["block"]): r for r in _summaries(_within(lines, open_files)).collect()}
    splits, enters, start, file = [], False, (None, None), None
    for r in seen:
        if r["file"] != file:
            if enters:
                raise ValueError(f"a quote is still open at the end of {file or name!r}")
            enters, start, file = False, (None, None), r["file"]
        plain = not enters and not r["opens"]
        splits.append(Split(r["file"], r["block"], enters, plain, *(start if enters else (None, None))))
        effect = effects.get((r["file"], r["block"]))
        if effect is not None:
            begins = effect[f"start_{int(enters)}"]
            enters = effect[f"behind_{int(enters)}"]
            start = (r["block"], begins) if enters and begins is not None else start
    if enters:
        raise ValueError(f"a quote is still open at the end of {file or name!r}")
    return Layout(splits, firsts)


def _within(lines: DataFrame, files: list[str]) -> DataFrame:
    """Lines of some files; many names are a table, not an expression."""
    if len(files) <= NAMED:
        return lines.where(F.col("file").isin(files))
    named = lines.sparkSession.createDataFrame([(f,) for f in files], "file string")
    return lines.join(named, "file", "left_semi")


_SPLITS = "file string, block long, enters boolean, plain boolean, start_block long, start_line long"


def records(lines: DataFrame, layout: Layout) -> DataFrame:
    """Records with their place and without their end; blank lines are empty records."""
    text = F.rtrim(F.col("line"), F.lit(_LINE_ENDS)).alias("record")
    if layout.plain:
        return lines.select(*PLACE, text)
    spark = lines.sparkSession
    begun = spark.createDataFrame([s for s in layout.splits if not s.plain], _SPLITS).drop("plain")
    straight = lines.join(begun.select("file", "block"), ["file", "block"], "left_anti").select(*PLACE, text)

    opens, stays = _opens(F.col("line")), ~F.col("line").contains('"') | ~F.col("line").rlike(_CLOSED_AFTER_OPEN)
    entered = lines.join(begun, ["file", "block"]).withColumns({"opens": opens, "stays": stays})
    marked = entered.select(*PLACE, "line", "enters", "start_block", "start_line", *_functions())
    open_before = _open_before(F.col("enters"))
    in_order = marked.select(*PLACE, "line", "start_block", "start_line", (~open_before).alias("starts"))
    own = F.last(F.when(F.col("starts"), F.col("line_no")), ignorenulls=True).over(
        Window.partitionBy("file", "block").orderBy("line_no")
    )
    placed = in_order.select(
        *PLACE,
        "line",
        F.when(own.isNull(), F.col("start_block")).otherwise(F.col("block")).alias("start_block"),
        F.coalesce(own, F.col("start_line")).alias("start_line"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "line_no", "line")))
    gathered = placed.groupBy(
        "file", F.col("start_block").alias("block"), F.col("start_line").alias("line_no")
    ).agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "").alias("line"))
    return straight.unionByName(gathered.select(*PLACE, text))


def cells_of(record: Column) -> Column:
    """The cells of a record, as Python's csv module gives them."""
    raw = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(_NEXT_CELL), F.lit(1))

    def unquoted(cell: Column) -> Column:
        body = F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.when(
            cell.startswith('"'), F.concat(body, F.regexp_extract(cell, _QUOTED, 2))
        ).otherwise(cell)

    return F.when(record.contains('"'), F.transform(raw, unquoted)).otherwise(F.split(record, ",", -1))


def first_records(lines: DataFrame, layout: Layout) -> dict[str, tuple[int, str]]:
    """Of each file the count and the text of the first record that is not empty.

    Mostly that is the first line, and lines are read only until all first lines are
    found. Where it is blank or leaves a quote open, a job over the records finds it.
    """
    at = {line_no: file for file, line_no in layout.firsts.items()}
    found = _numbered(lines, list(at)).select("line_no", "line", _opens(F.col("line")).alias("opens"))
    firsts = {}
    for r in found.limit(len(at)).collect():
        text = r["line"].rstrip(_LINE_ENDS)
        if text and not r["opens"]:
            firsts[at[r["line_no"]]] = (r["line_no"], text)
    rest = sorted(set(layout.firsts) - set(firsts))
    if rest:
        some = _within(records(lines, layout).where("record <> ''"), rest)
        for r in some.groupBy("file").agg(F.min(F.struct("block", "line_no", "record")).alias("r")).collect():
            firsts[r["file"]] = (r["r"]["line_no"], r["r"]["record"])
    return firsts


def _numbered(lines: DataFrame, numbers: list[int]) -> DataFrame:
    if len(numbers) <= NAMED:
        return lines.where(F.col("line_no").isin(numbers))
    named = lines.sparkSession.createDataFrame([(n,) for n in numbers], "line_no long")
    return lines.join(named, "line_no", "left_semi")
