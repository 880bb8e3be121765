"""The feeds bound to a star schema of parquet tables.

The engine reads four text feeds and a bridge. Here these are derived from the
whole tables ``lineitem``, ``part`` and ``supplier``: every line item is a
ledger movement, every part a product with an account of its own, every supplier
a merchant. Amounts and dates are turned into the untidy text exports contain,
so each operator has the work it has on real files. Attributes of the rows
(sizes, brands, types) decide which product is special: without an account,
with two, under two notes, without expectations.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashweave.functions.names import merchant_key, merchant_norm
from cashweave.operators.typed import REPAYMENT_MEASURES

# Tables whose rows are turned into text and parsed again, and up to which size
# they are dealt out.
_ROW_TABLES = ("lineitem",)
SPREAD_BYTES = 64 << 20

# Parts per supplier in the generated tables.
_PARTS_PER_MERCHANT = 20

# Remarks in turn, by order and line number. They hit exact and
# regex rules, padded and mixed case ones, ties, and no rule at all.
REMARKS = [
    "Merchant-Repayment",
    " merchant-repayment ",
    "merchant-repayment",
    "note-issued-transfer-to-sku",
    "Transfer to SKU account",
    "fh-admin-fee",
    "acquirer-fee",
    "Monthly Management Fee",
    "INT-DIFF",
    "senior-investor-principal",
    "senior-investor-interest",
    "Sr Interest and Sr Principal",
    "junior-investor-interest",
    "jr principal, part one",
    "SPARkle bonus",
    "loan-disbursement",
    "",
    None,
]


class Bound:
    """Text feeds and reference tables over one directory of parquet files."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table, opened once."""
        if name not in self._read:
            self._read[name] = self._open(name)
        return self._read[name]

    def _open(self, name: str) -> DataFrame:
        """A table as it is split; one of a few MB in a single piece is dealt to all cores.

        Each of its rows is rendered as text and parsed again, which one core
        would otherwise do alone. Beyond ``SPREAD_BYTES`` files have splits.
        """
        table = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if name in _ROW_TABLES and size <= SPREAD_BYTES and table.rdd.getNumPartitions() < cores:
            return table.repartition(cores, "l_orderkey", "l_partkey")
        return table

    @cached_property
    def merchant(self) -> DataFrame:
        name = F.col("s_name")
        return self.table("supplier").select(
            merchant_key(name).alias("merchant_id"),
            name.alias("merchant_name"),
            merchant_norm(name).alias("merchant_name_norm"),
        )

    @cached_property
    def sku(self) -> DataFrame:
        return self.table("part").select(
            _sku(F.col("p_partkey")).alias("sku_id"),
            merchant_key(_merchant_name(F.col("p_partkey"))).alias("merchant_id"),
        )

    @cached_property
    def bridge_batch(self) -> DataFrame:
        """The mapping file: note, product, account."""
        part = F.col("p_partkey")
        own = (F.col("p_size") != 50, F.lit(None).cast("string"), part)
        next_one = (F.col("p_brand") == "Brand#10", F.lit(None).cast("string"), part + 1)
        second_note = (F.col("p_size") == 7, F.lit("N2"), part)
        kinds = F.array(
            *[
                F.when(
                    wanted,
                    F.struct(
                        note.alias("note_id"),
                        _sku(part).alias("sku_id"),
                        _account(account).alias("va_number"),
                    ),
                )
                for wanted, note, account in (own, next_one, second_note)
            ]
        )
        return self.table("part").select(F.inline(F.array_compact(kinds)))

    @cached_property
    def bridge(self) -> DataFrame:
        part = F.substring_index("sku_id", "-", -1).cast("long")
        return self.bridge_batch.select(
            "note_id",
            "sku_id",
            "va_number",
            merchant_key(_merchant_name(part)).alias("merchant_id"),
            F.lit(None).cast("date").alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
        )

    @cached_property
    def external_accounts(self) -> DataFrame:
        """Bank pulls: every line item."""
        padded = F.concat(F.lit(" "), _account(F.col("l_partkey")), F.lit(" "))
        return (
            self.table("lineitem")
            .select(
                padded.alias("beneficiary_bank_account_number"),
                F.concat(F.lit("RM "), _amount("l_extendedprice")).alias("buy_amount"),
                F.lit("MYR ").alias("buy_currency"),
                _date_text().alias("created_date"),
            )
        )

    @cached_property
    def va_txn(self) -> DataFrame:
        """The ledger. Few senders, so outflows crowd on few products."""
        no_receiver = (F.col("l_tax") == 0) & (F.col("l_discount") == 0)
        turn = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(REMARKS)))
        return self.table("lineitem").select(
            F.concat(F.lit("S-"), F.col("l_suppkey")).alias("sender_virtual_account_id"),
            _account(F.col("l_suppkey")).alias("sender_virtual_account_number"),
            F.lit("").alias("sender_note_id"),
            F.concat(F.lit("R-"), F.col("l_partkey")).alias("receiver_virtual_account_id"),
            F.when(~no_receiver, _account(F.col("l_partkey"))).alias(
                "receiver_virtual_account_number"
            ),
            F.lit(None).cast("string").alias("receiver_note_id"),
            _amount("l_quantity").alias("receiver_va_opening_balance"),
            F.lit("-").alias("receiver_va_closing_balance"),
            F.when(F.col("l_quantity") == 50, "n/a")
            .otherwise(_amount("l_extendedprice"))
            .alias("amount"),
            _date_text().alias("date"),
            F.element_at(F.array(*[F.lit(r) for r in REMARKS]), (turn + 1).cast("int")).alias(
                "remarks"
            ),
        )

    @cached_property
    def repmt_sku(self) -> DataFrame:
        """Repayments of every part; those of size 13 are under another product name."""
        price, size = _amount("p_retailprice"), F.col("p_size").cast("string")
        # Prices, sizes and untidy zeros in turn.
        texts = [price, size, F.concat(F.lit("RM "), size), F.lit(" - ")]
        measures = {m: texts[i % len(texts)] for i, m in enumerate(REPAYMENT_MEASURES)}
        return (
            self.table("part")
            .select(
                _merchant_name(F.col("p_partkey")).alias("merchant"),
                F.concat(
                    F.when(F.col("p_size") == 13, "NEW-").otherwise("SKU-"), F.col("p_partkey")
                ).alias("sku_id"),
                *[text.alias(m) for m, text in measures.items()],
            )
        )

    @cached_property
    def repmt_sales(self) -> DataFrame:
        """Sales of every line item; one part in 17 is under a product name no longer in use."""
        return (
            self.table("lineitem")
            .select(
                F.concat(_merchant_name(F.col("l_partkey")), F.lit(" ")).alias("merchant"),
                F.concat(
                    F.lit(" "),
                    F.when(F.col("l_partkey") % 17 == 0, "OLD-").otherwise("SKU-"),
                    F.col("l_partkey"),
                ).alias("sku_id"),
                _amount("l_extendedprice").alias("total_funds_inflow"),
                _amount("l_extendedprice").alias("sales_proceeds"),
                _amount("l_quantity").alias("l2e"),
            )
        )

    @cached_property
    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "external_accounts": self.external_accounts,
            "repmt_sales": self.repmt_sales,
            "repmt_sku": self.repmt_sku,
            "va_txn": self.va_txn,
        }


def _sku(part: Column) -> Column:
    return F.concat(F.lit("SKU-"), part)


def _account(number: Column) -> Column:
    return F.concat(F.lit("VA-"), number)


def _merchant_name(part: Column) -> Column:
    number = F.floor(part / _PARTS_PER_MERCHANT).cast("string")
    return F.concat(F.lit("Supplier#"), F.lpad(number, 9, "0"))


def _amount(column: str) -> Column:
    return F.format_number(F.col(column).cast("double"), 2)


def _date_text() -> Column:
    """Four formats by line number, one with a time, and junk for quantity 1."""
    day = F.col("l_shipdate")
    formats = ["M/d/yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy"]
    turn = F.pmod(F.col("l_linenumber"), F.lit(len(formats)))
    text = reduce(
        lambda rest, i: F.when(turn == i, F.date_format(day, formats[i])).otherwise(rest),
        range(len(formats)),
        F.lit(None).cast("string"),
    )
    timed = F.when(turn == 0, F.concat(text, F.lit(" 14:22"))).otherwise(text)
    return F.when(F.col("l_quantity") == 1, "pending").otherwise(timed)
