"""The feeds: canonical columns, the header names exports use, CSV in and out."""

from __future__ import annotations

import csv
import io
import re
import warnings
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cashweave.functions.names import normalise_header
from cashweave.functions.parsing import blank_to_null
from cashweave.sources import quoted


@dataclass(frozen=True)
class FeedSpec:
    """A feed: file pattern, and per canonical column the accepted headers.

    Headers are compared after ``normalise_header``, in this order, and the
    canonical name itself comes last.
    """

    name: str
    pattern: str
    aliases: dict[str, list[str]]

    @property
    def columns(self) -> list[str]:
        return list(self.aliases)


# File patterns, canonical columns and accepted headers.
EXTERNAL_ACCOUNTS = FeedSpec(
    "external_accounts",
    "external_accounts_*.csv",
    {
        "beneficiary_bank_account_number": [
            "beneficiary bank account number",
            "beneficiary bank account no",
            "beneficiary account number",
            "bank account number",
            "receiver bank account number",
            "receiver virtual account number",
            "receiver va number",
        ],
        "buy_amount": ["buy amount", "amount", "total amount", "pull amount"],
        "buy_currency": ["buy currency", "currency", "buy ccy", "ccy"],
        "created_date": [
            "created date",
            "transaction date",
            "completed date",
            "value date",
            "date",
        ],
    },
)

VA_TXN = FeedSpec(
    "va_txn",
    "va_txn_*.csv",
    {
        "sender_virtual_account_id": ["sender virtual account id", "sender va id"],
        "sender_virtual_account_number": [
            "sender virtual account number",
            "sender va number",
            "sender bank account number",
            "sender account number",
        ],
        "sender_note_id": [
            "sender note id",
            "sender ref id",
            "sender reference id",
            "sender note",
        ],
        "receiver_virtual_account_id": ["receiver virtual account id", "receiver va id"],
        "receiver_virtual_account_number": [
            "receiver virtual account number",
            "receiver va number",
            "beneficiary bank account number",
            "receiver bank account number",
            "receiver account number",
        ],
        "receiver_note_id": [
            "receiver note id",
            "receiver ref id",
            "receiver reference id",
            "receiver note",
        ],
        "receiver_va_opening_balance": [
            "receiver va opening balance",
            "opening balance receiver",
            "receiver opening balance",
        ],
        "receiver_va_closing_balance": [
            "receiver va closing balance",
            "closing balance receiver",
            "receiver closing balance",
        ],
        "amount": ["amount", "transaction amount", "amt"],
        "date": ["date", "transaction date", "created date", "completed date", "value date"],
        "remarks": ["remarks", "comment", "memo", "description"],
    },
)

REPMT_SKU = FeedSpec(
    "repmt_sku",
    "repmt_sku_*.csv",
    {
        "merchant": ["merchant", "merchant name", "spar merchant"],
        "sku_id": ["sku id", "sku", "note id"],
        "acquirer_fees_expected": ["acquirer fees expected", "acquirer fee expected"],
        "acquirer_fees_paid": ["acquirer fees paid", "acquirer fee paid"],
        "fh_admin_fees_expected": [
            "fh admin fees expected",
            "administrative fees expected",
            "admin fees expected",
        ],
        "fh_admin_fees_paid": [
            "fh admin fees paid",
            "administrative fees paid",
            "admin fees paid",
        ],
        "int_difference_expected": ["int difference expected", "interest difference expected"],
        "int_difference_paid": ["int difference paid", "interest difference paid"],
        "sr_principal_expected": ["sr principal expected", "senior principal expected"],
        "sr_principal_paid": ["sr principal paid", "senior principal paid"],
        "sr_interest_expected": ["sr interest expected", "senior interest expected"],
        "sr_interest_paid": ["sr interest paid", "senior interest paid"],
        "jr_principal_expected": ["jr principal expected", "junior principal expected"],
        "jr_principal_paid": ["jr principal paid", "junior principal paid"],
        "jr_interest_expected": ["jr interest expected", "junior interest expected"],
        "jr_interest_paid": ["jr interest paid", "junior interest paid"],
        "spar_merchant": ["spar merchant", "spar"],
        "additional_interests_paid_to_fh": [
            "additional interests paid to fh",
            "fh platform fee",
            "platform fee",
        ],
    },
)

REPMT_SALES = FeedSpec(
    "repmt_sales",
    "repmt_sales_*.csv",
    {
        "merchant": ["merchant", "merchant name"],
        "sku_id": ["sku id", "sku", "note id"],
        "total_funds_inflow": [
            "total funds inflow",
            "total inflow",
            "fund inflow",
            "funds inflow",
        ],
        "sales_proceeds": ["sales proceeds", "sales proceed", "proceeds"],
        "l2e": ["l2 e", "l2e", "l2+e", "l2_e"],
    },
)

FEEDS = [EXTERNAL_ACCOUNTS, VA_TXN, REPMT_SKU, REPMT_SALES]

# The mapping file has no aliases.
MAPPING_COLUMNS = ["note_id", "sku_id", "va_number"]

PREPPED_SUFFIX = "_prepped.csv"
#: Where a loaded row is from.
SOURCE_FILE = "source_file"


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Path and name of the files of a directory that match a glob.

    Only the listing is read: the content column is pruned.
    """
    try:
        found = (
            spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
        )
    except AnalysisException:
        return spark.createDataFrame([], "path string, name string")
    return found.select("path", F.substring_index("path", "/", -1).alias("name"))


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something to read at exactly this path."""
    directory, _, name = path.rstrip("/").rpartition("/")
    return first_named(spark, directory or ".", name) is not None


def first_named(spark: SparkSession, directory: str, pattern: str) -> str | None:
    """First file by name that matches and is not a normalised copy."""
    row = (
        list_files(spark, directory, pattern)
        .where(~F.col("name").endswith(PREPPED_SUFFIX) | F.lit(pattern.endswith(PREPPED_SUFFIX)))
        .agg(F.min("name").alias("name"))
        .first()
    )
    return None if row["name"] is None else f"{directory.rstrip('/')}/{row['name']}"


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files of a path: itself, those of a directory, or those a glob names; by name."""
    directory, _, name = path.rstrip("/").rpartition("/")
    if not re.search(r"[*?\[{]", name):
        if file_exists(spark, path):
            return [path]
        directory, name = path.rstrip("/"), "*"
    listed = list_files(spark, directory or ".", name).where(~F.col("name").rlike("^[._]"))
    return [f"{directory or '.'}/{r['name']}" for r in listed.orderBy("name").collect()]


def find_feed(
    spark: SparkSession, directory: str, pattern: str, override: str | None = None
) -> str:
    """The file of one feed.

    An override is a path, or a path under the directory; it may be a directory
    of files, or a glob, and then all of them are read. Without one it is the
    first file by name that matches the pattern; others are named in a warning.
    """
    if override:
        for path in (override, f"{directory.rstrip('/')}/{override}"):
            if files_of(spark, path):
                return path
        raise FileNotFoundError(f"no file {override!r}, nor under {directory!r}")
    found = first_named(spark, directory, pattern)
    if found is None:
        raise FileNotFoundError(f"no file matching {pattern!r} in {directory!r}")
    others = [
        r["name"]
        for r in list_files(spark, directory, pattern).orderBy("name").collect()
        if r["name"] != found.rpartition("/")[2] and not r["name"].endswith(PREPPED_SUFFIX)
    ]
    if others:
        warnings.warn(f"{pattern}: only {found} is read, not {others}", stacklevel=2)
    return found


def find_feeds(
    spark: SparkSession, directory: str, overrides: dict[str, str] | None = None
) -> dict[str, str]:
    """The files of all four feeds; all missing ones are named in the error."""
    overrides = overrides or {}
    found, missing = {}, []
    for spec in FEEDS:
        try:
            found[spec.name] = find_feed(spark, directory, spec.pattern, overrides.get(spec.name))
        except FileNotFoundError as error:
            missing.append(str(error))
    if missing:
        raise FileNotFoundError("; ".join(missing))
    return found


class Table(NamedTuple):
    """Files of CSV lines with a header each: their lines, how splits begin, and their headers."""

    lines: DataFrame
    layout: quoted.Layout
    headers: dict[str, tuple[int, tuple[str, ...]]]  # file to the header's line and its cells

    @property
    def forms(self) -> list[tuple[str, ...]]:
        """The different headers, in order of their files."""
        return list(dict.fromkeys(cells for _, cells in self.headers.values()))


def table_of(lines: DataFrame, name: str = "the lines") -> Table:
    """Files of lines (``quoted.lines_of``) and their headers. ``line_no`` is unique over all files."""
    layout = quoted.layout_of(lines, name)
    firsts = quoted.first_records(lines, layout)
    headers = {
        file: (line_no, tuple(next(csv.reader(io.StringIO(record, newline="")))))
        for file, (line_no, record) in sorted(firsts.items())
    }
    return Table(lines, layout, headers)


def opened(spark: SparkSession, path: str) -> Table:
    """All files of a path (a file, a directory, a glob) in one scan."""
    return table_of(quoted.lines_of(spark, path), path)


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Whether some record spans lines. Such a file is read in parallel as well."""
    return not quoted.layout_of(quoted.lines_of(spark, path), path).plain


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Header cells as they are, without a byte order mark; of several files those of the first."""
    return list(next((cells for _, cells in opened(spark, path).headers.values()), ()))


def _rows(table: Table, wanted: list[list[int]], names: list[str], exact: bool) -> DataFrame:
    """File and text cells of all records but headers; ``wanted`` has their positions for each form.

    exact: a record with another number of cells than there are names is an error.
    """
    records = quoted.records(table.lines, table.layout).where("record <> ''")
    if len(wanted) == 1 and len(table.headers) <= quoted.NAMED:
        positions = [F.lit(p) for p in wanted[0]]
        # The count of a line is unique over all files.
        data = records.where(~F.col("line_no").isin([line for line, _ in table.headers.values()]))
    else:
        number = {cells: i for i, cells in enumerate(table.forms)}
        known = [(file, line, number[cells]) for file, (line, cells) in table.headers.items()]
        forms = records.sparkSession.createDataFrame(known, "file string, header long, form int")
        positions = [
            F.get(F.array(*[F.lit(w[i]) for w in wanted]), F.least("form", F.lit(len(wanted) - 1)))
            for i in range(len(names))
        ]
        data = records.join(forms, "file").where("line_no <> header")
    parsed = data.select(
        "file", "record", quoted.cells_of(F.col("record")).alias("cells"), *[p.alias(f"p{i}") for i, p in enumerate(positions)]
    )
    if exact:
        # Of the cells as a column: an expression that is repeated here would be computed twice.
        shape = F.concat(F.lit(f"malformed record, {len(names)} cells expected: "), F.left("record", F.lit(200)))
        whole = F.when(F.size("cells") == len(names), F.col("cells")).otherwise(F.raise_error(shape))
        parsed = parsed.withColumn("cells", whole)
    return parsed.select(
        F.col("file").alias(SOURCE_FILE),
        *[blank_to_null(F.get("cells", f"p{i}")).alias(n) for i, n in enumerate(names)],
    )


def preview_headers(spark: SparkSession, path: str) -> DataFrame:
    """Raw and normalised header names, in file order."""
    rows = [(i, h, normalise_header(h)) for i, h in enumerate(header_of(spark, path))]
    return spark.createDataFrame(rows, "position int, raw string, normalised string")


def resolve_columns(headers: list[str], spec: FeedSpec) -> dict[str, int]:
    """Position of every canonical column.

    Of headers that are equal after normalising, the last one counts. Raises
    when a column is missing, naming what was found.
    """
    position = {normalise_header(h): i for i, h in enumerate(headers)}
    resolved, missing = {}, []
    for column, aliases in spec.aliases.items():
        accepted = [normalise_header(a) for a in [*aliases, column]]
        hit = next((position[a] for a in accepted if a in position), None)
        if hit is None:
            missing.append(column)
        else:
            resolved[column] = hit
    if missing:
        raise ValueError(
            f"{spec.name}: missing columns {missing}; found {headers}, "
            f"normalised {[normalise_header(h) for h in headers]}"
        )
    return resolved


def read_feed(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """One export as text columns in canonical names and order.

    Columns are taken by position, so repeated header names do no harm. Of a
    directory or a glob every file is read, each by its own header, in one scan.
    """
    return feed_rows(opened(spark, path), spec)


def feed_rows(table: Table, spec: FeedSpec) -> DataFrame:
    """Canonical columns of files of lines, whatever forms of headers they have."""
    forms = [resolve_columns(list(cells), spec) for cells in table.forms or [()]]
    rows = _rows(table, [[f[c] for c in spec.columns] for f in forms], spec.columns, exact=False)
    return rows.drop(SOURCE_FILE)


def canonicalise(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rename a frame's columns to the canonical ones; extra ones are dropped."""
    where = resolve_columns(df.columns, spec)
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"c{i}").alias(column) for column, i in where.items()]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; missing and empty cells are both written as nothing.

    Blanks around a value stay: trimming is up to the typed tables.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def load_columns(
    spark: SparkSession, path: str, columns: list[str], source: bool = False
) -> DataFrame:
    """A ``.csv`` or ``.csv.gz`` whose columns are known by position.

    The header line of each file is skipped, not read. A row with too few or too
    many cells is an error; an empty cell is NULL. ``source`` adds the file.
    """
    rows = _rows(opened(spark, path), [list(range(len(columns)))], columns, exact=True)
    return rows if source else rows.drop(SOURCE_FILE)


def with_load_columns(df: DataFrame) -> DataFrame:
    """Add where (if df has it) and when a row was loaded."""
    known = SOURCE_FILE in df.columns
    source = F.col(SOURCE_FILE) if known else F.lit(None).cast("string")
    rest = [F.col(f"`{c}`") for c in df.columns if c != SOURCE_FILE]
    return df.select(source.alias(SOURCE_FILE), F.current_timestamp().alias("load_at"), *rest)


def write_raw(df: DataFrame, path: str, fresh: bool = False) -> None:
    """Append to a raw table, or replace it."""
    df.write.mode("overwrite" if fresh else "append").parquet(path)


def load_mapping_file(spark: SparkSession, path: str) -> DataFrame | None:
    """The mapping rows, or None when the file holds a header only."""
    if not file_exists(spark, path):
        raise FileNotFoundError(f"no mapping file {path!r}")
    rows = load_columns(spark, path, MAPPING_COLUMNS)
    return None if rows.isEmpty() else rows
