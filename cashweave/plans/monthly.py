"""The monthly run: exports in, tables and marts out, checks at the end.

Everything is written below one directory, layer by layer, and read back from
there: a lost executor costs the tasks it ran, never an earlier layer, and no
plan grows longer than one layer. A rerun over the same inputs replaces the
directory's tables with equal ones. Reference data are published: all four tables
change at once, and a run that ends early leaves the earlier ones (``store``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from cashweave.operators import ledger, transfers, typed, upserts
from cashweave.operators.categorise import RULE_SCHEMA, SHIPPED_RULES, Rule, rules_frame
from cashweave.plans import level1 as l1, level2 as l2, quality
from cashweave.plans.store import Store
from cashweave.session import configure
from cashweave.sources import feeds, records

MERCHANT_SCHEMA = "merchant_id string, merchant_name string, merchant_name_norm string"
SKU_SCHEMA = "sku_id string, merchant_id string"
BRIDGE_SCHEMA = (
    "note_id string, sku_id string, va_number string, merchant_id string, "
    "valid_from date, valid_to date"
)


def _rows() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))}


def normalise_feeds(
    store: Store, in_dir: str, overrides: dict[str, str] | None = None
) -> dict[str, str]:
    """Write every feed under its canonical columns; gives the files used."""
    sources = feeds.find_feeds(store.spark, in_dir, overrides)
    for spec in feeds.FEEDS:
        rows = feeds.read_feed(store.spark, sources[spec.name], spec)
        feeds.write_csv(rows, store.prepped(spec.name), mode="overwrite")
    return sources


def extract_mapping(store: Store, in_dir: str, explicit: str | None = None) -> str:
    """Write the mapping file from the reference export; gives the file used."""
    export = records.find_reference_export(store.spark, in_dir, explicit)
    pairs = records.extract_block(store.spark, export)
    feeds.write_csv(pairs, store.prepped("note_sku_va_map"), mode="overwrite")
    return export


def load_raw(store: Store, fresh: bool = True) -> None:
    """Load the normalised feeds into the raw layer, replacing or appending; rows are counted meanwhile."""
    for spec in feeds.FEEDS:
        rows = feeds.load_columns(store.spark, store.prepped(spec.name), spec.columns, source=True)
        mode = "overwrite" if fresh else "append"
        store.write_observed(feeds.with_load_columns(rows), "raw", spec.name, _rows(), mode)


def load_reference(
    store: Store, previous: Store | None = None, rules: Iterable[Rule] = SHIPPED_RULES
) -> None:
    """Merchants, products, bridge and rules.

    Merchants, products and rules of the previous run stay, which may be an
    earlier one in the same directory; the bridge is rebuilt from the mapping
    file. All tables are published together, and none when the mapping is bad.
    """
    spark = store.spark
    known = previous.current("ref") if previous else None

    def before(name: str, schema: str) -> DataFrame:
        kept = known.find(name) if known else previous.find("ref", name) if previous else None
        return spark.createDataFrame([], schema) if kept is None else kept

    raw_sales, raw_expected = (store.read("raw", n) for n in ("repmt_sales", "repmt_sku"))
    merchant = upserts.upsert_merchants(before("merchant", MERCHANT_SCHEMA), raw_sales)
    sku = upserts.upsert_skus(before("sku", SKU_SCHEMA), merchant, raw_sales)
    bridge = spark.createDataFrame([], BRIDGE_SCHEMA)
    batch = feeds.load_columns(spark, store.prepped("note_sku_va_map"), feeds.MAPPING_COLUMNS)
    if not batch.isEmpty():

        def stage(df: DataFrame) -> DataFrame:
            store.write(df, "staging", "mapping")
            return store.read("staging", "mapping")

        sku, bridge = upserts.load_mapping(
            batch, raw_sales, raw_expected, merchant, sku, bridge, stage
        )
    old_rules = before("remarks_category_map", RULE_SCHEMA)
    store.publish(
        "ref",
        {
            "merchant": merchant,
            "sku": sku,
            "note_sku_va_map": bridge,
            "remarks_category_map": upserts.add_rules(old_rules, rules_frame(spark, rules)),
        },
    )


def refresh(store: Store) -> list[str]:
    """Rebuild the core layer from the raw one, and the marts, in order of dependence.

    A table whose inputs are not there is left out; gives the tables written.
    """
    raw = {spec.name: store.find("raw", spec.name) for spec in feeds.FEEDS}
    ref = store.current("ref")
    rules, bridge = (ref.find(n) if ref else None for n in ("remarks_category_map", "note_sku_va_map"))
    written = []

    def write(name: str, df: DataFrame, by: str | None = None) -> None:
        store.write(df, "core", name, by=by)
        written.append(name)

    if raw["external_accounts"] is not None:
        write("external_accounts", typed.typed_external(raw["external_accounts"]))
        write("pull_totals", typed.pull_totals(store.read("core", "external_accounts")))
    if raw["va_txn"] is not None:
        # The ledger is parsed here and nowhere else. It is not bucketed by account: one
        # account may have a third of it, and what is joined or moved are sums.
        write("ledger", typed.typed_ledger(raw["va_txn"], trim_remarks=False))
    matched = raw["va_txn"] is not None and rules is not None and bridge is not None
    if matched:
        write("va_txn", ledger.va_txn(store.read("core", "ledger"), rules, bridge))
    if raw["repmt_sku"] is not None:
        write("repmt_sku", typed.typed_expected(raw["repmt_sku"]))
    if raw["repmt_sales"] is not None:
        write("repmt_sales", typed.typed_sales(raw["repmt_sales"]))
        write("sale_totals", typed.sale_totals(store.read("core", "repmt_sales")))
    if matched:
        flows = ledger.va_txn_flows(store.read("core", "ledger"), rules, bridge)
        write("va_txn_flows", flows, by="period_ym")
        # The marts need sums only. They share this small table instead of
        # scanning the flows once each.
        write("flow_totals", ledger.totals_of(core_flows(store)))
    if matched and all(df is not None for df in raw.values()):
        write_marts(store)
    return written


def core_flows(store: Store) -> DataFrame:
    """The flows as written; the period is text, also as a directory name."""
    return store.spark.read.schema(ledger.FLOWS_SCHEMA).parquet(
        store.path("core", "va_txn_flows")
    )


def marts(store: Store) -> dict[str, DataFrame]:
    """The marts as built from the core layer; ``written_marts`` are those of the run."""
    ref = store.current("ref")
    merchant, sku, bridge = (ref.read(n) for n in ("merchant", "sku", "note_sku_va_map"))
    external, expected, sales, totals, rows = (
        store.read("core", n)
        for n in ("pull_totals", "repmt_sku", "sale_totals", "flow_totals", "ledger")
    )
    pivot = ledger.flows_pivot(totals)
    moved = transfers.transfer_totals(rows, bridge)
    level1 = l1.level1(bridge, merchant, external, totals, sales)
    return {
        "flows_pivot": pivot,
        "inter_sku_transfers": transfers.inter_sku_transfers(rows, bridge),
        "inter_sku_transfers_agg": moved,
        "level1": level1,
        "level1_export": l1.level1_export(level1),
        "level2a": l2.level2a(pivot, expected, sku, sales, moved, merchant),
        "level2b": l2.level2b(sku, merchant, sales, expected, pivot),
    }


def write_marts(store: Store) -> None:
    """Write the marts; level 2 is built from the parts written before it."""
    views = marts(store)
    for name in ("flows_pivot", "inter_sku_transfers_agg"):
        store.write(views[name], "mart", name)
    outside = F.count_if(quality.is_outside(*quality.PUBLISHED_BAND))
    store.write_observed(views["level1"], "mart", "level1", {**_rows(), "outside": outside})
    pivot, moved = (store.read("mart", n) for n in ("flows_pivot", "inter_sku_transfers_agg"))
    ref = store.current("ref")
    merchant, sku = (ref.read(n) for n in ("merchant", "sku"))
    expected, sales = (store.read("core", n) for n in ("repmt_sku", "sale_totals"))
    store.write(l2.level2a(pivot, expected, sku, sales, moved, merchant), "mart", "level2a")
    store.write(l2.level2b(sku, merchant, sales, expected, pivot), "mart", "level2b")


WRITTEN_MARTS = ("flows_pivot", "inter_sku_transfers_agg", "level1", "level2a", "level2b")


def written_marts(store: Store) -> dict[str, DataFrame]:
    """The marts as the run wrote them."""
    tables = {name: store.read("mart", name) for name in WRITTEN_MARTS}
    return {**tables, "level1_export": l1.level1_export(tables["level1"])}


# The names analysts query the tables and views under.
PUBLISHED = {
    ("raw", "external_accounts"): "external_accounts",
    ("raw", "va_txn"): "va_txn",
    ("raw", "repmt_sku"): "repmt_sku",
    ("raw", "repmt_sales"): "repmt_sales",
    ("ref", "merchant"): "merchant",
    ("ref", "sku"): "sku",
    ("ref", "note_sku_va_map"): "note_sku_va_map",
    ("ref", "remarks_category_map"): "remarks_category_map",
    ("core", "external_accounts"): "mv_external_accounts",
    ("core", "va_txn"): "mv_va_txn",
    ("core", "repmt_sku"): "mv_repmt_sku",
    ("core", "repmt_sales"): "mv_repmt_sales",
    ("core", "va_txn_flows"): "mv_va_txn_flows",
}
PUBLISHED_VIEWS = {
    "flows_pivot": "v_flows_pivot",
    "inter_sku_transfers": "v_inter_sku_transfers",
    "inter_sku_transfers_agg": "v_inter_sku_transfers_agg",
    "level1": "v_level1",
    "level1_export": "v_level1_export",
    "level2a": "v_level2a",
    "level2b": "v_level2b",
}


def publish_views(store: Store) -> list[str]:
    """Register everything as temporary views of this session."""
    names = []
    ref = store.current("ref")  # views of one version
    for (layer, table), name in PUBLISHED.items():
        source = ref.read(table) if layer == "ref" else store.read(layer, table)
        df = core_flows(store) if table == "va_txn_flows" else source
        df.createOrReplaceTempView(name)
        names.append(name)
    views = written_marts(store)
    # The transfer rows are a view over the ledger: there can be many more of them.
    views["inter_sku_transfers"] = transfers.inter_sku_transfers(
        store.read("core", "ledger"), ref.read("note_sku_va_map")
    )
    for mart, name in PUBLISHED_VIEWS.items():
        views[mart].createOrReplaceTempView(name)
        names.append(name)
    return names


def save_marts(store: Store, database: str = "mart") -> None:
    """Save the marts as catalog tables, so that ``mart.v_level1`` can be queried."""
    store.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    views = written_marts(store)
    for name in ("level1", "level1_export", "level2a", "level2b"):
        views[name].write.mode("overwrite").saveAsTable(f"{database}.{PUBLISHED_VIEWS[name]}")


def _raw_data(store: Store) -> DataFrame:
    """From the counts of the load; tables that were not counted then are counted now."""
    counts = [store.metrics("raw", spec.name) for spec in feeds.FEEDS]
    if None in counts:
        return quality.check_raw_data({s.name: store.read("raw", s.name) for s in feeds.FEEDS})
    total = int(sum(c["rows"] for c in counts))
    return quality.raw_data_result(store.spark.createDataFrame([(total,)], "n long"), F.col("n"))


def _tolerance(store: Store, level1: DataFrame, severity: str) -> DataFrame:
    seen = store.metrics("mart", "level1")
    if seen is None:
        return quality.check_tolerance(level1, severity=severity)
    facts = store.spark.createDataFrame([(int(seen["outside"]),)], "n long")
    return quality.tolerance_result(facts, severity)


def suite(
    store: Store,
    golden: DataFrame | None = None,
    fail_on_variance: bool = False,
) -> DataFrame:
    """All checks of a run, as one frame of results."""
    spark = store.spark
    views = written_marts(store)
    level1 = views["level1"]
    external, sales, totals = (
        store.read("core", n) for n in ("pull_totals", "sale_totals", "flow_totals")
    )
    bridge = store.read("ref", "note_sku_va_map")
    headers = {
        spec.name: (feeds.header_of(spark, store.prepped(spec.name)), spec.columns)
        for spec in feeds.FEEDS
    }
    headers["note_sku_va_map"] = (
        feeds.header_of(spark, store.prepped("note_sku_va_map")),
        feeds.MAPPING_COLUMNS,
    )
    checks = [
        quality.check_headers(spark, headers),
        _raw_data(store),
        quality.check_coverage(sales, bridge),
        quality.check_row_counts(sales, level1, views["level2a"], views["level2b"]),
        quality.check_totals(level1, external, bridge, totals, sales),
    ]
    if golden is not None:
        checks.append(quality.check_parity(golden, level1))
    severity = quality.FAIL if fail_on_variance else quality.WARN
    checks.append(_tolerance(store, level1, severity))
    return quality.run_checks(checks)


def load_month(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    previous: str | None = None,
    overrides: dict[str, str] | None = None,
    reference: str | None = None,
    rules: Iterable[Rule] = SHIPPED_RULES,
) -> Store:
    """Normalise, load, map and refresh.

    ``previous`` is the out_dir of the run that this one continues, which may be
    the same directory.
    """
    configure(spark)
    store = Store(spark, out_dir)
    normalise_feeds(store, in_dir, overrides)
    extract_mapping(store, in_dir, reference)
    load_raw(store)
    load_reference(store, Store(spark, previous) if previous else None, rules)
    refresh(store)
    return store


def verify_month(
    store: Store, reference: str | None = None, fail_on_variance: bool = False
) -> list[Row]:
    """Run all checks, against the reference export too if one is given."""
    golden = records.golden_level1(store.spark, reference) if reference else None
    return quality.enforce(suite(store, golden, fail_on_variance))


# Three outflows without a receiver, to see the paid buckets fill.
DEMO_OUTFLOWS = [
    ("na", "8850633926172", "44", "3.01", "9/30/2025", "fh-admin-fee"),
    ("na", "8850633926172", "44", "2.51", "9/30/2025", "management fee"),
    ("na", "8850633926172", "44", "91", "9/30/2025", "sr principal"),
]


def append_demo_outflows(store: Store) -> None:
    """Append the demo outflows to the raw ledger and refresh."""
    given = [
        "sender_virtual_account_id",
        "sender_virtual_account_number",
        "sender_note_id",
        "amount",
        "date",
        "remarks",
    ]
    rows = store.spark.createDataFrame(DEMO_OUTFLOWS, ", ".join(f"{c} string" for c in given))
    full = rows.select(
        *[
            F.col(c) if c in given else F.lit(None).cast("string").alias(c)
            for c in feeds.VA_TXN.columns
        ]
    )
    store.write_observed(feeds.with_load_columns(full), "raw", "va_txn", _rows(), mode="append")
    refresh(store)
