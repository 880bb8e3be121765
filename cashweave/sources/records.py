"""Spreadsheet exports: CSV with a preamble, where the order of rows matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashweave.functions.money import to_cents
from cashweave.functions.parsing import accounting_amount, strip_text
from cashweave.sources import quoted
from cashweave.sources.feeds import file_exists, list_files


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records of one file with their place (``block``, ``line_no``)."""
    return _records(quoted.lines_of(spark, path), path)


def records_of(source: DataFrame, name: str = "the lines") -> DataFrame:
    """CSV records of lines (``block``, ``line_no``, ``line``), the first of them in block 0.

    No blank line is lost, because blank lines end a report block. Raises
    ValueError if a quote is still open at the end.
    """
    return _records(quoted.lines_in(source), name)


def _records(lines: DataFrame, name: str) -> DataFrame:
    return quoted.records(lines, quoted.layout_of(lines, name)).drop("file")


def _cells(record: Column, n: int) -> list[Column]:
    cells = quoted.cells_of(record)
    return [strip_text(F.coalesce(F.get(cells, F.lit(i)), F.lit(""))) for i in range(n)]


def extract_block(spark: SparkSession, path: str) -> DataFrame:
    """Product and account pairs of a file's report block: note_id, sku_id, va_number."""
    return block_of(read_records(spark, path), path)


def block_of(records: DataFrame, path: str = "the lines") -> DataFrame:
    """Product and account pairs of the report block: note_id, sku_id, va_number.

    The block starts below the first row with "SKU ID" in one of its first two
    cells, and ends at the first row without a product or account or with a
    total. Cells are one to the right where the first is blank.
    """
    first, second, third = _cells(F.col("record"), 3)
    shifted = first == ""
    rows = records.select(
        F.struct("block", "line_no").alias("place"),
        (F.lower(first) == "sku id").alias("header_first"),
        (F.lower(second) == "sku id").alias("header_second"),
        F.when(shifted, second).otherwise(first).alias("sku_id"),
        F.when(shifted, third).otherwise(second).alias("va_number"),
        (F.lower(second) == "account number").alias("is_heading"),
    )
    header = rows.agg(
        F.min(F.when(F.col("header_first") | F.col("header_second"), F.col("place"))).alias("p")
    ).first()["p"]
    if header is None:
        raise ValueError(f"no 'SKU ID' header in {path!r}")

    def place(row) -> Column:
        return F.struct(F.lit(row["block"]).alias("block"), F.lit(row["line_no"]).alias("line_no"))

    below = rows.where(F.col("place") > place(header))
    stops = (
        (F.col("sku_id") == "")
        | (F.col("va_number") == "")
        | F.lower("sku_id").startswith("total")
    )
    end = below.agg(F.min(F.when(stops, F.col("place"))).alias("p")).first()["p"]
    block = below if end is None else below.where(F.col("place") < place(end))
    pairs = block.where(~F.col("is_heading")).select(
        F.lit(None).cast("string").alias("note_id"), "sku_id", "va_number"
    )
    if pairs.isEmpty():
        raise ValueError(f"no product and account pairs below the header in {path!r}")
    return pairs


# Names the reference export may have, in order of preference.
REFERENCE_NAMES = [
    "level1_reference.csv",
    "level1_formula_output.csv",
    "level1_formula.csv",
    "formula_output_level1.csv",
    "formula_and_output_level1.csv",
    "formula_output.csv",
    "Sample Files((1) Formula & Output).csv",
    "Sample Files((1) Formula & Output).CSV",
]


def find_reference_export(spark: SparkSession, directory: str, explicit: str | None = None) -> str:
    """The level-1 reference export.

    An explicit path if it exists, else one of the usual names, else any CSV
    about formula and output, preferably one that looks like level 1.
    """
    if explicit and file_exists(spark, explicit):
        return explicit
    base = directory.rstrip("/")
    files = list_files(spark, base)
    usual = F.array_position(F.array(*[F.lit(n) for n in REFERENCE_NAMES]), F.col("name"))
    lower = F.lower("name")
    loose = (
        F.col("name").endswith(".csv") & lower.contains("formula") & lower.contains("output")
    )
    level1 = lower.contains("level1") | lower.contains("(1") | lower.contains("_1")
    best = files.agg(
        F.min(F.when(usual > 0, F.struct(usual.alias("rank"), F.col("name")))).alias("usual"),
        F.max(F.when(loose, F.struct(level1.alias("level1"), lower.alias("key"), F.col("name")))).alias(
            "loose"
        ),
    ).first()
    chosen = best["usual"] or best["loose"]
    if chosen is None:
        raise FileNotFoundError(f"no level-1 reference export in {directory!r}")
    return f"{base}/{chosen['name']}"


# Heading in the reference export -> column of the level-1 mart.
GOLDEN_COLUMNS = {
    "SKU ID": "sku_id",
    "Account Number": "account_number",
    "Merchant": "merchant",
    "Amount Pulled": "amount_pulled",
    "Amount Received": "amount_received",
    "Sales Proceeds": "sales_proceeds",
}


def golden_level1(spark: SparkSession, path: str) -> DataFrame:
    """Expected level-1 rows out of the reference export, in cents."""
    return golden_of(read_records(spark, path), path)


def golden_of(records: DataFrame, path: str = "the lines") -> DataFrame:
    """Level-1 rows below the first record that has the headings, whatever their order."""
    place = F.struct("block", "line_no")
    likely = records.where(
        F.col("record").contains("SKU ID") & F.col("record").contains("Account Number")
    )
    commas = F.length(F.regexp_replace("record", "[^,]", ""))
    width = (likely.agg(F.max(commas)).first()[0] or 0) + 1
    named = likely.withColumn("names", F.array(*_cells(F.col("record"), width))).where(
        F.array_contains("names", "SKU ID") & F.array_contains("names", "Account Number")
    )
    header = named.agg(F.min(F.struct("block", "line_no", "names")).alias("h")).first()["h"]
    if header is None:
        raise ValueError(f"no level-1 header in {path!r}")
    names = list(header["names"])
    wanted = {new: names.index(old) for old, new in GOLDEN_COLUMNS.items()}
    cells = _cells(F.col("record"), max(wanted.values()) + 1)
    start = F.struct(
        F.lit(header["block"]).alias("block"), F.lit(header["line_no"]).alias("line_no")
    )
    rows = records.where(place > start).select(
        *[cells[i].alias(column) for column, i in wanted.items()]
    )
    amounts = ("amount_pulled", "amount_received", "sales_proceeds")
    return rows.where(F.col("sku_id") != "").select(
        "sku_id",
        "account_number",
        "merchant",
        *[to_cents(accounting_amount(F.col(a))).alias(a) for a in amounts],
    )


def golden_in_order(golden: DataFrame) -> DataFrame:
    """Under the report headings, sorted as the golden file is."""
    back = {new: old for old, new in GOLDEN_COLUMNS.items()}
    return golden.orderBy("sku_id", "account_number").select(
        *[F.col(c).alias(back[c]) for c in GOLDEN_COLUMNS.values()]
    )


def level1_amounts_export(mart: DataFrame) -> DataFrame:
    """The mart as the golden file has it: headings, and amounts in cents."""
    return golden_in_order(
        mart.select(
            *[
                to_cents(F.col(c)).alias(c)
                if c in ("amount_pulled", "amount_received", "sales_proceeds")
                else F.col(c)
                for c in GOLDEN_COLUMNS.values()
            ]
        )
    )


__all__ = [
    "extract_block",
    "find_reference_export",
    "golden_in_order",
    "golden_level1",
    "golden_of",
    "level1_amounts_export",
    "read_records",
]
