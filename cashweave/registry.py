"""Every operator as a query over a directory of parquet tables.

Amounts leave a query as decimal(18,2) and days as text, so that results can be
compared between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cashweave.functions.money import CENTS
from cashweave.functions.names import header_key
from cashweave.functions.parsing import accounting_amount, to_date_safe, to_numeric_safe
from cashweave.operators import ledger, transfers, typed, upserts
from cashweave.operators.categorise import (
    SHIPPED_RULES,
    UNCATEGORISED,
    Rule,
    categorise,
    rules_frame,
)
from cashweave.operators.positions import with_positions
from cashweave.plans import level1 as l1, level2 as l2, quality, reports
from cashweave.plans.store import Store
from cashweave.scratch import passing, shared_folder, written
from cashweave.session import configure
from cashweave.sources import feeds, records
from cashweave.sources.bound import Bound

Query = Callable[[SparkSession, str], DataFrame]

_FEE = T.DecimalType(18, 4)


def presented(df: DataFrame) -> DataFrame:
    """Decimals in cents (computed fees in hundredths of that), days as text."""

    def column(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            fee = field.name.startswith("FH Platform Fee")
            return col.cast(_FEE if fee else CENTS).alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.DateType)):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        return col

    return df.select(*[column(f) for f in df.schema.fields])


class Tables(Bound):
    """Core tables and marts over the bound feeds, built when asked for."""

    @cached_property
    def external(self) -> DataFrame:
        return typed.typed_external(self.external_accounts)

    @cached_property
    def expected(self) -> DataFrame:
        return typed.typed_expected(self.repmt_sku)

    @cached_property
    def sales(self) -> DataFrame:
        return typed.typed_sales(self.repmt_sales)

    @cached_property
    def txn(self) -> DataFrame:
        return ledger.va_txn(self.va_txn, SHIPPED_RULES, self.bridge)

    @cached_property
    def txn_counts(self) -> DataFrame:
        return ledger.txn_counts(self.va_txn, SHIPPED_RULES, self.bridge)

    @cached_property
    def flows(self) -> DataFrame:
        return ledger.va_txn_flows(self.va_txn, SHIPPED_RULES, self.bridge)

    @cached_property
    def flow_totals(self) -> DataFrame:
        return ledger.flow_totals(self.va_txn, SHIPPED_RULES, self.bridge)

    @cached_property
    def pivot(self) -> DataFrame:
        return ledger.flows_pivot(self.flow_totals)

    @cached_property
    def transfer_rows(self) -> DataFrame:
        return transfers.inter_sku_transfers(self.va_txn, self.bridge)

    @cached_property
    def transfer_totals(self) -> DataFrame:
        return transfers.transfer_totals(self.va_txn, self.bridge)

    @cached_property
    def level1(self) -> DataFrame:
        return l1.level1(self.bridge, self.merchant, self.external, self.flow_totals, self.sales)

    @cached_property
    def level2a(self) -> DataFrame:
        return l2.level2a(
            self.pivot,
            self.expected,
            self.sku,
            self.sales,
            self.transfer_totals,
            self.merchant,
        )

    @cached_property
    def level2b(self) -> DataFrame:
        return l2.level2b(self.sku, self.merchant, self.sales, self.expected, self.pivot)


def _safe_numeric(t: Tables) -> DataFrame:
    parsed = to_numeric_safe(F.col("amount"))
    return t.va_txn.groupBy(F.col("sender_virtual_account_number").alias("va_number")).agg(
        F.sum(parsed).alias("amount"), F.count(parsed).alias("n_parsed")
    )


def _safe_date(t: Tables) -> DataFrame:
    rows = t.va_txn.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(
        F.col("date").alias("date_text"), to_date_safe(F.col("date")).alias("day"), "n"
    )


def _period_totals(t: Tables) -> DataFrame:
    return t.external.groupBy("period_ym").agg(
        F.sum("buy_amount").alias("buy_amount"), F.count(F.lit(1)).alias("n")
    )


def _accounting_parse(t: Tables) -> DataFrame:
    return t.repmt_sku.groupBy("merchant").agg(
        *[F.sum(accounting_amount(F.col(m))).alias(m) for m in typed.REPAYMENT_MEASURES]
    )


def _header_keys(t: Tables) -> DataFrame:
    raw = t.va_txn.select(F.col("remarks").alias("raw")).distinct()
    return raw.select("raw", header_key(F.col("raw")).alias("normalised"))


def _canonical_sales(t: Tables) -> DataFrame:
    """The sales feed under headings as exports have them, back under its own."""
    headings = ["Merchant-Name", "note id", "SKU  ID", "Funds  INFLOW", "Sales_Proceed ", "L2+E", "more"]
    rows = t.repmt_sales.select("merchant", F.lit("no"), "sku_id", "total_funds_inflow", "sales_proceeds", "l2e", F.lit("x"))
    return typed.typed_sales(feeds.canonicalise(rows.toDF(*headings), feeds.REPMT_SALES))


def _lines(rows: DataFrame, key: str, text, per_block: int = 1000) -> DataFrame:
    """Rows as lines of text with their place: some rows are several lines, over the ends of blocks too."""
    each = rows.select(F.col(key).cast("long").alias("key"), F.posexplode(F.split(text, "\n")).alias("nth", "line"))
    numbered = each.select((F.col("key") * 8 + F.col("nth")).alias("line_no"), "line")
    return numbered.select(F.floor(F.col("line_no") / per_block).alias("block"), "line_no", "line")


def _feed_lines(t: Tables) -> DataFrame:
    """Two files of CSV lines with headers of their own, and quoted cells over several lines."""
    number = F.col("p_partkey").cast("string")
    name = F.concat(F.lit('"Supplier ""'), number, F.lit('"",\nof "'))
    broken = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"\n'), number, F.lit('\n\n"'))).otherwise("")
    first = F.concat_ws(",", name, F.concat(F.lit("S"), number), F.col("p_size"), number, broken)
    second = F.concat_ws(",", F.concat(F.lit("S"), number), name, number, F.col("p_size"), F.lit('"x"y'), broken)
    files = []
    heads = {
        "a": ("merchant,SKU,total inflow,proceeds,l2e", first),
        "b": ('SKU ID,"Merchant\nName",Sales Proceed,Fund-Inflow,x,L2+E', second),
    }
    for i, (file, (head, text)) in enumerate(heads.items()):
        body = _lines(t.table("part").where(F.col("p_partkey") % 2 == i), "p_partkey", text)
        # The count of a line is unique over all files.
        body = body.withColumn("line_no", F.col("line_no") + (i << 41))
        top = [(-1, n - 8 * (i + 1), line) for n, line in enumerate(head.split("\n"))]
        lines = t.spark.createDataFrame(top, "block long, line_no long, line string").unionByName(body)
        files.append(lines.select(F.lit(file).alias("file"), "block", "line_no", F.concat("line", F.lit("\n")).alias("line")))
    return feeds.feed_rows(feeds.table_of(files[0].unionByName(files[1])), feeds.REPMT_SALES)


def _report_block(t: Tables) -> DataFrame:
    """The block of a report: all parts, after a preamble and before a total and other rows."""
    part = t.table("part")
    number = F.col("p_partkey").cast("string")
    note = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit('"see\n\n""'), number, F.lit('"""'))).otherwise(number)
    row = F.concat_ws(",", F.concat(F.lit("SKU-"), number), F.concat(F.lit(" VA-"), number), note)
    inside = _lines(part, "p_partkey", row)
    below = _lines(part, "p_partkey", row).withColumns(
        {"block": F.col("block") + (1 << 40), "line_no": F.col("line_no") + (1 << 43)}
    )
    top = ["Report,x", "", '"About', 'SKU ID",y', "SKU ID,Account Number,Note"]
    fixed = [(-1, n, line) for n, line in enumerate(top)] + [(1 << 39, 1 << 42, "Total of all,9")]
    lines = t.spark.createDataFrame(fixed, "block long, line_no long, line string")
    return records.block_of(records.records_of(lines.unionByName(inside).unionByName(below)))


def _golden_rows(t: Tables) -> DataFrame:
    """A reference export of all orders: columns in an order of its own, cells as people leave them."""
    order, number = t.table("orders"), F.col("o_orderkey").cast("string")
    customer, status = F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    price = F.format_number("o_totalprice", 2)
    sku = F.when(status == "O", "").otherwise(F.concat(F.lit(" SKU-"), number))
    merchant = F.when(
        F.col("o_custkey") % 3 == 0, F.concat(F.lit('"M ""'), customer, F.lit('"",\nand ""sons"""'))
    ).otherwise(F.concat(F.lit("M-"), customer, F.lit(" ")))
    received = F.when(status == "P", " - ").otherwise(F.format_string('"%s"', price))
    sold = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(customer)
    row = F.concat_ws(",", merchant, F.lit("x"), sku, sold, F.concat(F.lit("VA-"), number), received, F.format_string('" %s "', price))
    top = [
        "Formula and output,SKU ID", "", '"About', 'SKU ID, Account Number"',
        "Merchant,,SKU ID,Sales Proceeds,Account Number,Amount Received,Amount Pulled",
    ]
    head = t.spark.createDataFrame([(-1, n, text) for n, text in enumerate(top)], "block long, line_no long, line string")
    return records.golden_of(records.records_of(head.unionByName(_lines(order, "o_orderkey", row))))


def _exported(t: Tables, df: DataFrame, spec: feeds.FeedSpec) -> str:
    """A feed as CSV files under headings as exports have them; their folder."""
    headings = [f"{spec.aliases[c][1].title().replace(' ', '_')} " for c in spec.columns]
    path = f"{shared_folder(t.spark)}/export-{spec.name}-{uuid.uuid4().hex}"
    feeds.write_csv(df.select(*spec.columns).toDF(*headings), path)
    return path


def _prepped(t: Tables, df: DataFrame, spec: feeds.FeedSpec) -> str:
    """The exported feed under canonical headings; the folder of its files."""
    path = f"{shared_folder(t.spark)}/prepped-{spec.name}-{uuid.uuid4().hex}"
    feeds.write_csv(feeds.read_feed(t.spark, _exported(t, df, spec), spec), path)
    return path


def _accounts_from_files(t: Tables) -> DataFrame:
    spec = feeds.EXTERNAL_ACCOUNTS
    return typed.typed_external(feeds.read_feed(t.spark, _exported(t, t.external_accounts, spec), spec))


def _repayments_from_files(t: Tables) -> DataFrame:
    spec = feeds.REPMT_SKU
    return typed.typed_expected(feeds.read_feed(t.spark, _exported(t, t.repmt_sku, spec), spec))


def _ledger_from_files(t: Tables) -> DataFrame:
    """From exported files to canonical ones, and these loaded by position."""
    spec = feeds.VA_TXN
    return typed.typed_ledger(feeds.load_columns(t.spark, _prepped(t, t.va_txn, spec), spec.columns))


def _check_headers(t: Tables) -> DataFrame:
    """Canonical files have the headings they should, exported ones do not."""
    sales, sku = feeds.REPMT_SALES, feeds.REPMT_SKU
    files = [(sales, _prepped(t, t.repmt_sales, sales)), (sku, _exported(t, t.repmt_sku, sku))]
    found = {spec.name: (feeds.header_of(t.spark, path), spec.columns) for spec, path in files}
    return quality.check_headers(t.spark, found)


def _unread_cells(t: Tables) -> DataFrame:
    """Cells with a text that is neither an amount nor a date, by feed."""

    def unread(df: DataFrame, feed: str, amount: str, date: str) -> DataFrame:
        lost = [
            F.count(F.when(F.col(c).isNotNull() & read(F.col(c)).isNull(), 1))
            for c, read in ((amount, to_numeric_safe), (date, to_date_safe))
        ]
        return df.agg(lost[0].alias("amounts"), lost[1].alias("dates")).select(
            F.lit(feed).alias("feed"), "amounts", "dates"
        )

    return unread(t.va_txn, "va_txn", "amount", "date").unionByName(
        unread(t.external_accounts, "external_accounts", "buy_amount", "created_date")
    )


def _add_rules(t: Tables) -> DataFrame:
    """Rules on file, and one for every brand of parts; a pair that is there stays."""
    new = t.table("part").select(
        F.lower("p_brand").alias("raw_pattern"),
        F.lit("brand").alias("category_code"),
        F.lit(False).alias("is_regex"),
        F.lit(90).alias("priority"),
    )
    known = rules_frame(t.spark, [*SHIPPED_RULES, Rule("brand#10", "brand", True, 5)])
    return upserts.add_rules(known, new.distinct())


def _categorise(strategy: str) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        rows = categorise(
            typed.typed_ledger(t.va_txn), SHIPPED_RULES, default=UNCATEGORISED, strategy=strategy
        )
        return rows.select("sender_va", "receiver_va", "amount", "remarks", "category_code")

    return query


# Rules with every form of pattern that Java writes otherwise.
_POSIX_RULES = [
    Rule(r"^[[:space:]]*merchant-[[:alpha:]]+[[:space:]]*$", "padded", True, 10),
    Rule(r"\mint", "begins int", True, 20),
    Rule(r"[[:<:]]sku[[:>:]]", "a sku", True, 30),
    Rule(r"fee\M", "ends fee", True, 40),
    Rule(r"\yinterest\y.*\yprincipal\y", "both", True, 50),
    Rule(r"^[^[:digit:][:blank:]]{3,}-[[:alnum:]]+-[]a-z]{4,8}[[:blank:]]?", "dashes", True, 60),
    Rule(r"(?:jr|sr)[ ]", "short", True, 70),
    Rule(r"***=b", "a letter", True, None),
]


def _categorise_posix(t: Tables) -> DataFrame:
    rows = categorise(typed.typed_ledger(t.va_txn, trim_remarks=False), _POSIX_RULES, default=UNCATEGORISED)
    return rows.groupBy("remarks", "category_code").agg(F.count(F.lit(1)).alias("n"))


def _first_rows(t: Tables) -> DataFrame:
    rows = l1.universe(t.bridge, t.merchant)
    by_sku, by_va = (
        l1.first_rows(rows, group).select(
            F.lit(group).alias("group_by"), "sku_id", "va_number", "note_id"
        )
        for group in ("sku_id", "va_number")
    )
    return by_sku.unionByName(by_va)


def _origins(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Products of the sales feed, and of the repayment feed."""
    sold = t.sales.select("sku_id", F.lit("sales").alias("origin")).distinct()
    expected = t.expected.select("sku_id", F.lit("expected").alias("origin")).distinct()
    return sold, expected


def _insert_ignore(t: Tables) -> DataFrame:
    return upserts.insert_ignore(*_origins(t), ["sku_id"])


def _upsert(t: Tables) -> DataFrame:
    return upserts.upsert(*_origins(t), ["sku_id"])


def _stale_bridge(t: Tables) -> DataFrame:
    """A bridge of last month: every product on an account of its own."""
    return t.sku.select(
        F.lit("old").alias("note_id"),
        "sku_id",
        F.concat(F.lit("OLD-"), "sku_id").alias("va_number"),
        "merchant_id",
    )


def _replace_by(t: Tables) -> DataFrame:
    new = t.bridge.select("note_id", "sku_id", "va_number", "merchant_id")
    return upserts.replace_by(
        _stale_bridge(t), new, ["sku_id"], ["note_id", "va_number", "sku_id"]
    )


def _owners(t: Tables) -> DataFrame:
    """A repayment feed that names every product."""
    return t.sku.join(t.merchant, "merchant_id").select(
        F.concat(F.upper("merchant_name"), F.lit(" ")).alias("merchant"), "sku_id"
    )


def _load_mapping(t: Tables) -> DataFrame:
    return upserts.load_mapping(
        t.bridge_batch, t.repmt_sales, _owners(t), t.merchant, t.sku, _stale_bridge(t)
    ).bridge


def _load_mapping_skus(t: Tables) -> DataFrame:
    """The products after the load: those on file under another merchant move, those not mapped stay."""
    other = F.sha2(F.lit("Supplier#000000000"), 256)
    known = t.sku.where(F.substring_index("sku_id", "-", -1).cast("long") % 3 > 0)
    gone = t.sku.select(F.concat(F.lit("GONE-"), "sku_id").alias("sku_id"), "merchant_id")
    return upserts.load_mapping(
        t.bridge_batch,
        t.repmt_sales,
        _owners(t),
        t.merchant,
        known.withColumn("merchant_id", other).unionByName(gone),
        _stale_bridge(t),
    ).sku


def _validated_mapping(t: Tables) -> DataFrame:
    return upserts.validated_mapping(t.bridge_batch, t.repmt_sales, t.repmt_sku, t.merchant)


def _ordered_level1(t: Tables) -> DataFrame:
    """The export with the line each row is printed on."""
    rows = presented(l1.level1_export(t.level1))
    first = ["SKU ID", "Account Number", "Merchant"]
    return with_positions(rows, [*first, *[c for c in rows.columns if c not in first]])


def _ordered_level2a(t: Tables) -> DataFrame:
    rows = presented(t.level2a).select(*reports.PREVIEW_COLUMNS)
    first = ["SKU ID", "Merchant"]
    return with_positions(rows, [*first, *[c for c in rows.columns if c not in first]])


def _ordered_rules(t: Tables) -> DataFrame:
    return with_positions(_add_rules(t), ["priority", "raw_pattern", "category_code"])


def _known_merchants(t: Tables) -> DataFrame:
    """Merchants on file so far: suppliers of nation 15 and above."""
    return upserts.merchant_rows(
        t.table("supplier").where("s_nationkey >= 15").select(F.col("s_name").alias("merchant_name"))
    )


def _upsert_merchants(t: Tables) -> DataFrame:
    return upserts.upsert_merchants(_known_merchants(t), t.repmt_sales)


def _upsert_skus(t: Tables) -> DataFrame:
    nobody = t.sku.join(t.expected.select("sku_id"), "sku_id", "left_anti")
    return upserts.upsert_skus(nobody, t.merchant, t.repmt_sales)


def _add_bridge_rows(t: Tables) -> DataFrame:
    return upserts.add_bridge_rows(
        t.bridge.select("note_id", "sku_id", "va_number", "merchant_id"),
        t.merchant,
        "Supplier#000000001",
        [("44", "SKU-1", "VA-1"), ("44", "SKU-1", "VA-2"), ("N2", "SKU-1", "VA-1")],
    )


def _generous_level1(t: Tables) -> DataFrame:
    """Level 1 as if transfers to a product counted as received."""
    flows = t.flow_totals.withColumn(
        "category_code",
        F.when(F.col("category_code") == "funds_to_sku", "merchant_repayment").otherwise(
            F.col("category_code")
        ),
    )
    return l1.level1(t.bridge, t.merchant, t.external, flows, t.sales)


def _check_parity(t: Tables) -> DataFrame:
    return quality.check_parity(_generous_level1(t), t.level1)


def _parity_differences(t: Tables) -> DataFrame:
    return quality.parity_differences(_generous_level1(t), t.level1)


def _parity_removed(t: Tables) -> DataFrame:
    """Line items as rows of a mart, many for each key, against the same without every third line."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = t.table("lineitem").select(
        F.concat(F.lit("SKU-"), "l_partkey").alias("sku_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("VA-"), "l_partkey")).alias("account_number"),
        F.concat(F.lit("M-"), "l_returnflag").alias("merchant"),
        price.alias("amount_pulled"),
        F.when(F.col("l_linenumber") != 2, price).alias("amount_received"),
        F.col("l_quantity").cast("decimal(18,2)").alias("sales_proceeds"),
        "l_linenumber",
    )
    return quality.parity_differences(lines, lines.where("l_linenumber <> 3"))


def _key_differences(t: Tables) -> DataFrame:
    return quality.key_differences(t.sales, t.expected, ["sku_id"])


def _drilldown(t: Tables) -> DataFrame:
    """The report over the bound tables, in steps.

    Each feed is read once, into totals that are written, and each mart is a job of its
    own. So disk holds the shuffles of one step, not those of all.
    """
    with passing(t.spark) as kept:
        moved = kept(transfers.transfer_totals(t.va_txn, t.bridge, kept), "transfer-totals")
        # Without products and merchants, whose ids are most of a row of flow totals.
        totals = kept(ledger.account_totals(t.va_txn, SHIPPED_RULES), "account-totals")
        flows = ledger.of_products(totals, t.bridge)
        sold = kept(typed.sale_totals(t.sales), "sale-totals")
        pulls = kept(typed.pull_totals(t.external), "pull-totals")
        mart = l1.level1(t.bridge, t.merchant, pulls, flows, sold)
        two_a = l2.level2a(ledger.flows_pivot(flows), t.expected, t.sku, sold, moved, t.merchant)
        return reports.drilldown(mart, sold, two_a, "SKU-%", written)


def _checks(t: Tables) -> DataFrame:
    """The suite over the bound tables, as one frame of results.

    Each feed is read once, into totals that are written and counted on the way; what
    the marts and checks need comes from these.
    """
    store = Store(t.spark, f"{shared_folder(t.spark)}/suite-{uuid.uuid4().hex}")

    def written(name: str, df: DataFrame, **metrics) -> DataFrame:
        if metrics:
            store.write_observed(df, "core", name, metrics)
        else:
            store.write(df, "core", name)
        return store.read("core", name)

    rows = F.sum("n_rows")
    pulls = written("pull_totals", typed.pull_totals(t.external), rows=rows)
    sold = written("sale_totals", typed.sale_totals(t.sales), rows=rows)
    flows = written("flow_totals", t.flow_totals)
    moved = written("transfer_totals", t.transfer_totals)
    pivot = ledger.flows_pivot(flows)
    mart = written(
        "level1",
        l1.level1(t.bridge, t.merchant, pulls, flows, sold),
        outside=F.count_if(quality.is_outside(*quality.PUBLISHED_BAND)),
    )
    two_a = l2.level2a(pivot, t.expected, t.sku, sold, moved, t.merchant)
    two_b = l2.level2b(t.sku, t.merchant, sold, t.expected, pivot)
    # The ledger's and the repayments' rows are those of their files: nothing is parsed to count them.
    seen = sum(store.metrics("core", n)["rows"] for n in ("pull_totals", "sale_totals"))
    total = int(seen) + t.va_txn.count() + t.repmt_sku.count()
    outside = int(store.metrics("core", "level1")["outside"])
    return quality.run_checks(
        [
            quality.raw_data_result(t.spark.createDataFrame([(total,)], "n long"), F.col("n")),
            quality.check_coverage(sold, t.bridge),
            quality.check_row_counts(sold, mart, two_a, two_b),
            quality.check_totals(mart, pulls, t.bridge, flows, sold),
            quality.tolerance_result(t.spark.createDataFrame([(outside,)], "n long")),
        ]
    )


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # Parsers
    "safe_numeric": _safe_numeric,
    "safe_date": _safe_date,
    "period_totals": _period_totals,
    "accounting_parse": _accounting_parse,
    "header_keys": _header_keys,
    "merchant_norm": lambda t: t.merchant,
    # Feeds and reports as lines of text
    "canonical_sales": _canonical_sales,
    "feed_lines": _feed_lines,
    "report_block": _report_block,
    "golden_rows": _golden_rows,
    # Feeds as files
    "accounts_from_files": _accounts_from_files,
    "repayments_from_files": _repayments_from_files,
    "ledger_from_files": _ledger_from_files,
    "check_headers": _check_headers,
    # Typed tables
    "typed_external": lambda t: t.external,
    "typed_expected": lambda t: t.expected,
    "typed_sales": lambda t: t.sales,
    "typed_ledger": lambda t: typed.typed_ledger(t.va_txn),
    # Rule lookup and the ledger
    "categorise_case": _categorise("case"),
    "categorise_join": _categorise("join"),
    "categorise_posix": _categorise_posix,
    "va_txn": lambda t: t.txn,
    "category_breakdown": lambda t: ledger.category_breakdown(t.txn_counts),
    "va_txn_flows": lambda t: t.flows,
    "flow_totals": lambda t: t.flow_totals,
    "flow_summary": lambda t: ledger.flow_summary(t.flow_totals),
    "flows_pivot": lambda t: t.pivot,
    "received": lambda t: ledger.received(t.flow_totals),
    # Transfers
    "inter_sku_transfers": lambda t: t.transfer_rows,
    "transfers_agg": lambda t: transfers.transfers_agg(t.transfer_rows),
    "transfer_totals": lambda t: t.transfer_totals,
    "latest_transfers": lambda t: transfers.latest_transfers(t.va_txn, t.bridge),
    # Marts and their reports
    "first_rows": _first_rows,
    "level1": lambda t: t.level1,
    "level1_export": lambda t: l1.level1_export(t.level1),
    "level1_in_order": _ordered_level1,
    "level2a_in_order": _ordered_level2a,
    "rules_in_order": _ordered_rules,
    "level1_top_variance": lambda t: reports.level1_top_variance(t.level1),
    "variance_overview": lambda t: reports.variance_overview(t.level1),
    "level1_lookup": lambda t: reports.level1_rows_for(t.level1, "SKU-7", "VA-7"),
    "level1_count": lambda t: reports.level1_count(t.level1),
    "merchant_rollup": lambda t: reports.merchant_rollup(t.level1),
    "level2a": lambda t: t.level2a,
    "level2a_preview": lambda t: reports.level2a_preview(t.level2a),
    "level2b": lambda t: t.level2b,
    "drilldown": _drilldown,
    # Reference data
    "insert_ignore": _insert_ignore,
    "upsert": _upsert,
    "replace_by": _replace_by,
    "upsert_merchants": _upsert_merchants,
    "upsert_skus": _upsert_skus,
    "add_bridge_rows": _add_bridge_rows,
    "validated_mapping": _validated_mapping,
    "load_mapping": _load_mapping,
    "load_mapping_skus": _load_mapping_skus,
    "mapping_counts": lambda t: upserts.mapping_counts(t.bridge),
    "sku_coverage": lambda t: upserts.sku_coverage(t.sku, t.repmt_sales),
    # Checks and status
    "check_coverage": lambda t: quality.check_coverage(t.sales, t.bridge),
    "check_row_counts": lambda t: quality.check_row_counts(
        t.sales, t.level1, t.level2a, t.level2b
    ),
    "check_totals": lambda t: quality.check_totals(
        t.level1, t.external, t.bridge, t.flow_totals, t.sales
    ),
    "check_tolerance": lambda t: quality.check_tolerance(t.level1),
    "check_parity": _check_parity,
    "check_suite": _checks,
    "parity_differences": _parity_differences,
    "parity_removed": _parity_removed,
    "parity_self": lambda t: quality.parity_differences(t.level1, t.level1),
    "key_differences": _key_differences,
    "outside_band": lambda t: quality.outside_band(t.level1, Decimal("-4.00"), Decimal("0.05")),
    "unmapped_skus": lambda t: quality.unmapped_skus(t.sales, t.bridge),
    "exists_in": lambda t: reports.mapping_report(
        t.bridge.select("note_id", "sku_id", "va_number"), t.external
    ),
    "exists_in_with_null": lambda t: reports.mapping_report(
        t.bridge.select("note_id", "sku_id", "va_number"),
        t.external.select(F.nullif("va_number", F.lit("VA-1")).alias("va_number")),
    ),
    "unread_cells": _unread_cells,
    "add_rules": _add_rules,
    "chain_status": lambda t: reports.chain_status(
        t.bridge, t.external, t.sales, t.txn_counts, t.level1
    ),
    "raw_counts": lambda t: reports.raw_counts(t.raw_tables),
    "total_rows": lambda t: reports.total_rows(t.raw_tables),
    "remark_audit": lambda t: reports.remark_audit(t.va_txn),
    "top_pulled": lambda t: reports.top_pulled(t.external),
}


def _bound(build: Callable[[Tables], DataFrame]) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        return presented(build(Tables(configure(spark), directory.rstrip("/"))))

    return query


def registered() -> dict[str, Query]:
    return {name: _bound(build) for name, build in _QUERIES.items()}
