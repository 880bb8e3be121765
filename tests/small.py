"""Small literal feeds and tables for the tests."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cashweave.sources.feeds import EXTERNAL_ACCOUNTS, REPMT_SALES, REPMT_SKU, VA_TXN

BRIDGE = "note_id string, sku_id string, va_number string, merchant_id string"


def D(text):
    return None if text is None else Decimal(text)


def local(spark, entries, ddl):
    """A frame the planner knows to be tiny."""
    schema = StructType.fromDDL(ddl)
    dicts = [dict(zip(schema.names, e)) for e in entries]
    return spark.createDataFrame(pa.Table.from_pylist(dicts, to_arrow_schema(schema)), schema)


def _frame(spark, columns, rows):
    schema = ", ".join(f"{c} string" for c in columns)
    return local(spark, [tuple(r.get(c) for c in columns) for r in rows], schema)


def ledger(spark, *rows):
    """Rows (sender, receiver, amount, remarks[, date])."""
    return _frame(
        spark,
        VA_TXN.columns,
        [
            {
                "sender_virtual_account_number": r[0],
                "receiver_virtual_account_number": r[1],
                "amount": r[2],
                "remarks": r[3],
                "date": r[4] if len(r) > 4 else "9/30/2025",
            }
            for r in rows
        ],
    )


def external(spark, *rows):
    names = ("beneficiary_bank_account_number", "buy_amount")
    rows = [dict(zip(names, r), buy_currency="MYR", created_date="9/1/2025") for r in rows]
    return _frame(spark, EXTERNAL_ACCOUNTS.columns, rows)


def sales(spark, *rows):
    """Rows (merchant, sku, amount)."""
    rows = [
        {"merchant": m, "sku_id": s, "total_funds_inflow": a, "sales_proceeds": a}
        for m, s, a in rows
    ]
    return _frame(spark, REPMT_SALES.columns, rows)


def expected(spark, *rows):
    return _frame(spark, REPMT_SKU.columns, rows)


def bridge(spark, *rows):
    """Rows (note, sku, account, merchant id)."""
    return local(spark, rows, BRIDGE)


def merchants(spark, *ids):
    named = [(i, f"Merchant {i}") for i in ids]
    return local(spark, named, "merchant_id string, merchant_name string")


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])
