"""Expected results in SQL, over the same parquet tables.

Written for checking, so the plain way round: everything is computed row by row
from the definition. The matched ledger is never pre-aggregated, ranks are
row_number(), transfers pair up the products of both accounts, and the best rule
is the first of an ordered list. Only fixed values (rules, remarks, headings)
are shared with the engine.
"""

from __future__ import annotations

from cashweave.operators.categorise import SHIPPED_RULES
from cashweave.operators.ledger import PAID_CODES
from cashweave.operators.typed import REPAYMENT_MEASURES
from cashweave.plans.level1 import EXPORT_HEADINGS
from cashweave.plans.level2 import COMPARED, PREVIEW_COLUMNS, WATERFALL
from cashweave.sources.bound import REMARKS

_EXACT = "DECIMAL(24,6)"
_WIDE = "DECIMAL(38,6)"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _number(text: str) -> str:
    """Parse an amount the lenient way."""
    return f"TRY_CAST(regexp_replace({text}, '[^0-9.-]', '', 'g') AS {_EXACT})"


def _accounting(text: str) -> str:
    plain = f"replace(trim({text}), ',', '')"
    return (
        f"CASE WHEN {text} IS NULL OR {plain} IN ('', '-') THEN 0 "
        f"ELSE TRY_CAST({plain} AS {_EXACT}) END"
    )


def _day(text: str) -> str:
    """Parse a date: month first, year first, day first."""
    token = (
        f"translate(regexp_extract(trim({text}), "
        "'^[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}'), '-.', '//')"
    )
    attempts = ", ".join(
        f"try_strptime({token}, '{form}')" for form in ("%m/%d/%Y", "%Y/%m/%d", "%d/%m/%Y")
    )
    return f"CAST(COALESCE({attempts}) AS DATE)"


def _cents(expression: str, name: str, scale: int = 2) -> str:
    return f'CAST({expression} AS DECIMAL(18,{scale})) AS "{name}"'


def _iso(day: str, name: str) -> str:
    return f"strftime({day}, '%Y-%m-%d') AS {name}"


def _price(column: str) -> str:
    return f"format('{{:,.2f}}', CAST({column} AS DOUBLE))"


def _supplier_name(part: str) -> str:
    return f"'Supplier#' || lpad(CAST({part} // 20 AS VARCHAR), 9, '0')"


_DATE_TEXT = """CASE WHEN l_quantity = 1 THEN 'pending'
      WHEN l_linenumber % 4 = 0 THEN strftime(l_shipdate, '%-m/%-d/%Y') || ' 14:22'
      WHEN l_linenumber % 4 = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN l_linenumber % 4 = 2 THEN strftime(l_shipdate, '%Y/%m/%d')
      ELSE strftime(l_shipdate, '%d/%m/%Y') END"""

_RULE_ROWS = ",\n    ".join(
    f"({_text(r.raw_pattern)}, {_text(r.category_code)}, {str(r.is_regex).lower()}, {r.priority})"
    for r in SHIPPED_RULES
)

_REMARK_LIST = "[" + ", ".join(_text(r) for r in REMARKS) + "]"

_REPAYMENT_TEXTS = [
    _price("p_retailprice"),
    "CAST(p_size AS VARCHAR)",
    "'RM ' || p_size",
    "' - '",
]


def _repayment_columns() -> str:
    return ",\n      ".join(
        f"{_REPAYMENT_TEXTS[i % 4]} AS {m}" for i, m in enumerate(REPAYMENT_MEASURES)
    )


def _paid_columns() -> str:
    return ",\n      ".join(
        f"sum(CASE WHEN direction = 'outflow' AND category_code = '{code}' "
        f"THEN -signed_amount ELSE 0 END) AS {name}"
        for name, code in PAID_CODES.items()
    )


_TABLES = f"""
  merchant AS (
    SELECT sha256(s_name) AS merchant_id, s_name AS merchant_name FROM supplier),
  sku AS (
    SELECT 'SKU-' || p_partkey AS sku_id, sha256({_supplier_name("p_partkey")}) AS merchant_id
    FROM part),
  batch AS (
    SELECT CAST(NULL AS VARCHAR) AS note_id, p_partkey, p_partkey AS account
    FROM part WHERE p_size <> 50
    UNION ALL
    SELECT NULL, p_partkey, p_partkey + 1 FROM part WHERE p_brand = 'Brand#10'
    UNION ALL
    SELECT 'N2', p_partkey, p_partkey FROM part WHERE p_size = 7),
  bridge AS (
    SELECT note_id, 'SKU-' || p_partkey AS sku_id, 'VA-' || account AS va_number,
      sha256({_supplier_name("p_partkey")}) AS merchant_id
    FROM batch),
  external_text AS (
    SELECT ' VA-' || l_partkey || ' ' AS account, 'RM ' || {_price("l_extendedprice")} AS amount,
      'MYR ' AS currency, {_DATE_TEXT} AS created
    FROM lineitem),
  external AS (
    SELECT trim(account) AS va_number, {_number("amount")} AS buy_amount,
      trim(currency) AS buy_currency, {_day("created")} AS day
    FROM external_text),
  ledger_text AS (
    SELECT l_suppkey, l_partkey, l_quantity,
      'VA-' || l_suppkey AS sender_va,
      CASE WHEN l_tax = 0 AND l_discount = 0 THEN NULL ELSE 'VA-' || l_partkey END AS receiver_va,
      CASE WHEN l_quantity = 50 THEN 'n/a' ELSE {_price("l_extendedprice")} END AS amount_text,
      {_DATE_TEXT} AS date_text,
      {_REMARK_LIST}[1 + (l_orderkey + l_linenumber) % {len(REMARKS)}] AS remark_text
    FROM lineitem),
  ledger AS (
    SELECT sender_va, receiver_va, {_number("amount_text")} AS amount, {_day("date_text")} AS day,
      lower(trim(coalesce(remark_text, ''))) AS remarks,
      lower(coalesce(remark_text, '')) AS padded_remarks
    FROM ledger_text),
  rules(raw_pattern, category_code, is_regex, priority) AS (VALUES
    {_RULE_ROWS}),
  best_rule AS (
    SELECT r.remark,
      first(m.category_code ORDER BY m.priority, m.raw_pattern, m.category_code) AS category_code
    FROM (SELECT remarks AS remark FROM ledger UNION SELECT padded_remarks FROM ledger) r
    JOIN rules m ON CASE WHEN m.is_regex THEN regexp_matches(r.remark, m.raw_pattern, 'i')
                         ELSE r.remark = lower(m.raw_pattern) END
    GROUP BY r.remark),
  txn AS (
    SELECT coalesce(l.receiver_va, l.sender_va) AS va_number, b.sku_id, b.merchant_id,
      r.category_code, l.amount, l.day, l.padded_remarks AS remarks
    FROM ledger l
    LEFT JOIN best_rule r ON r.remark = l.padded_remarks
    LEFT JOIN bridge b ON b.va_number = l.receiver_va),
  flows AS (
    SELECT b.va_number, b.sku_id, b.merchant_id,
      coalesce(r.category_code, 'uncategorized') AS category_code, d.direction,
      l.amount AS raw_amount, d.sign * l.amount AS signed_amount, l.day, l.remarks
    FROM ledger l
    LEFT JOIN best_rule r ON r.remark = l.remarks
    CROSS JOIN (VALUES ('inflow', 1), ('outflow', -1)) d(direction, sign)
    JOIN bridge b ON b.va_number = CASE d.direction WHEN 'inflow' THEN l.receiver_va
                                                    ELSE l.sender_va END),
  buckets AS (
    SELECT sku_id, merchant_id,
      sum(CASE WHEN direction = 'inflow' AND category_code = 'merchant_repayment'
          THEN signed_amount ELSE 0 END) AS amount_received,
      {_paid_columns()}
    FROM flows GROUP BY sku_id, merchant_id),
  sent AS MATERIALIZED (
    SELECT l.sender_va, l.receiver_va, l.amount, l.day,
      s.sku_id AS from_sku_id, s.merchant_id AS from_merchant_id
    FROM ledger l JOIN bridge s ON s.va_number = l.sender_va),
  transfers AS (
    SELECT s.*, r.sku_id AS to_sku_id, r.merchant_id AS to_merchant_id
    FROM sent s JOIN bridge r ON r.va_number = s.receiver_va AND r.sku_id <> s.from_sku_id),
  moved AS (
    SELECT sku_id, merchant_id, sum(out_amount) AS moved_out, sum(in_amount) AS moved_in
    FROM (
      SELECT from_sku_id AS sku_id, from_merchant_id AS merchant_id,
        amount AS out_amount, 0 AS in_amount
      FROM transfers
      UNION ALL
      SELECT to_sku_id, to_merchant_id, 0, amount FROM transfers)
    GROUP BY sku_id, merchant_id),
  expected_text AS (
    SELECT {_supplier_name("p_partkey")} AS merchant,
      CASE WHEN p_size = 13 THEN 'NEW-' ELSE 'SKU-' END || p_partkey AS sku_id,
      {_repayment_columns()}
    FROM part),
  expected AS (
    SELECT merchant AS merchant_name, sku_id,
      {", ".join(f"{_number(m)} AS {m}" for m in REPAYMENT_MEASURES)},
      CAST(0 AS {_EXACT}) AS additional_admin_fee_expected,
      CAST(0 AS {_EXACT}) AS sr_add_interest_expected,
      CAST(0 AS {_EXACT}) AS jr_add_interest_expected
    FROM expected_text),
  sales AS (
    SELECT {_supplier_name("l_partkey")} AS merchant_name,
      CASE WHEN l_partkey % 17 = 0 THEN 'OLD-' ELSE 'SKU-' END || l_partkey AS sku_id,
      {_number(_price("l_extendedprice"))} AS total_funds_inflow,
      {_number(_price("l_extendedprice"))} AS sales_proceeds,
      {_number(_price("l_quantity"))} AS l2e
    FROM lineitem),
  ranked AS (
    SELECT b.*, m.merchant_name,
      row_number() OVER (PARTITION BY b.sku_id
        ORDER BY b.va_number NULLS LAST, b.note_id NULLS FIRST) AS sku_va_rank,
      row_number() OVER (PARTITION BY b.va_number
        ORDER BY b.sku_id NULLS LAST, b.note_id NULLS FIRST) AS va_sku_rank
    FROM bridge b JOIN merchant m ON m.merchant_id = b.merchant_id),
  pulled AS (
    SELECT va_number, sum(buy_amount) AS amount FROM external GROUP BY va_number),
  sold AS (
    SELECT sku_id, sum(sales_proceeds) AS amount, sum(total_funds_inflow) AS inflow
    FROM sales GROUP BY sku_id),
"""


def _level1(name: str, codes: str) -> str:
    return f"""
  {name}_received AS (
    SELECT sku_id, va_number,
      coalesce(sum(signed_amount) FILTER (category_code IN ({codes})), 0) AS amount FROM flows
    WHERE direction = 'inflow' GROUP BY sku_id, va_number),
  {name} AS (
    SELECT u.sku_id, u.va_number AS account_number, u.merchant_name AS merchant,
      CASE WHEN u.va_sku_rank = 1 THEN coalesce(p.amount, 0) ELSE 0 END AS amount_pulled,
      coalesce(r.amount, 0) AS amount_received,
      CASE WHEN u.sku_va_rank = 1 THEN coalesce(s.amount, 0) ELSE 0 END AS sales_proceeds
    FROM ranked u
    LEFT JOIN pulled p ON p.va_number = u.va_number
    LEFT JOIN {name}_received r ON r.sku_id = u.sku_id AND r.va_number = u.va_number
    LEFT JOIN sold s ON s.sku_id = u.sku_id),"""


def _level2a() -> str:
    paid = " + ".join(f"p.{b.paid}" for b in WATERFALL)
    sums = ", ".join(f"coalesce(sum(e.{b.expected}), 0) AS {b.expected}" for b in WATERFALL)
    flagged = [b for b in WATERFALL if b.flag]
    columns = [
        "coalesce(p.sku_id, e.sku_id) AS sku_key",
        "coalesce(p.merchant_id, e.merchant_id) AS merchant_key",
        'p.amount_received AS "Amount Received"',
        f'{paid} AS "Amount Distributed Down the Repayment Waterfall"',
        *[
            f"CASE WHEN p.{b.paid} > e.{b.expected} THEN 'Yes' ELSE 'No' END "
            f'AS "{b.flag} Paid > Expected?"'
            for b in flagged
        ],
        *[
            f"CASE WHEN e.{b.expected} <= p.{b.paid} THEN 'Yes' ELSE 'No' END "
            f'AS "{b.flag} Settled?"'
            for b in flagged
        ],
        *[f'p.{b.paid} AS "{b.name} Paid"' for b in WATERFALL],
        *[f'e.{b.expected} AS "{b.name} Expected"' for b in WATERFALL],
        *[f'e.{b.expected} - p.{b.paid} AS "{b.name} Outstanding"' for b in WATERFALL],
    ]
    listed = ",\n      ".join(columns)
    return f"""
  expected_sums AS (
    SELECT e.sku_id, k.merchant_id, {sums}
    FROM expected e JOIN sku k ON k.sku_id = e.sku_id GROUP BY e.sku_id, k.merchant_id),
  waterfall AS (
    SELECT {listed}
    FROM buckets p
    FULL JOIN expected_sums e ON e.sku_id = p.sku_id AND e.merchant_id = p.merchant_id),
  level2a AS (
    SELECT w.*, w.sku_key AS "SKU ID", m.merchant_name AS "Merchant",
      coalesce(t.moved_out, 0) AS "Fund Transferred to Other SKU",
      coalesce(t.moved_in, 0) AS "Fund Transferred from Other SKU",
      w."Amount Received" + coalesce(t.moved_in, 0)
        - w."Amount Distributed Down the Repayment Waterfall" - coalesce(t.moved_out, 0)
        AS "Variance",
      coalesce(s.amount, 0) AS "Sales Proceeds",
      CAST(0 AS {_EXACT}) AS "Merchant Top Up",
      CAST(0 AS {_EXACT}) AS "Disbursement Surplus",
      w."Amount Received" - coalesce(s.amount, 0) AS "Other"
    FROM waterfall w
    LEFT JOIN sold s ON s.sku_id = w.sku_key
    LEFT JOIN moved t ON t.sku_id = w.sku_key AND t.merchant_id = w.merchant_key
    LEFT JOIN merchant m ON m.merchant_id = w.merchant_key),"""


def _level2b() -> str:
    reported = ", ".join(f"sum({r.reported}) AS {r.reported}" for r in COMPARED)
    ui = {r.name: f"coalesce(u.{r.reported}, 0)" for r in COMPARED}
    cf = {r.name: f"coalesce(c.{r.ledger}, 0)" for r in COMPARED}
    fee = f"({cf['Senior Interest Paid']} + {cf['Junior Interest Paid']}) * 0.10"
    inflow = "coalesce(s.inflow, 0)"
    cash = "coalesce(c.amount_received, 0)"
    fee_ui = "coalesce(u.platform, 0)"
    heads = {"Administrative Fee Paid": "Adminstrative Fee Paid"}
    columns = [
        'k.sku_id AS "SKU ID"',
        'm.merchant_name AS "Merchant"',
        _cents(cash, "Total Fund Inflow"),
        *[_cents(cf[r.name], heads.get(r.name, r.name)) for r in COMPARED],
        _cents(fee, "FH Platform Fee", 4),
        _cents(f"{inflow} - {cash}", "Total Fund Inflow Variance"),
        *[_cents(f"{ui[r.name]} - {cf[r.name]}", f"{r.name} Variance") for r in COMPARED],
        _cents(f"{fee_ui} - {fee}", "FH Platform Fee Variance", 4),
        *[_cents(ui[r.name], f"{r.name} (UI)") for r in COMPARED],
        *[_cents(cf[r.name], f"{r.name} (CF)") for r in COMPARED],
        _cents(fee_ui, "FH Platform Fee (UI)", 4),
        _cents(fee, "FH Platform Fee (Calc.)", 4),
        _cents(inflow, "Total Fund Inflow (UI)"),
        _cents(cash, "Amount Received (CF)"),
    ]
    listed = ",\n      ".join(columns)
    return f"""
  reported AS (
    SELECT sku_id, {reported}, sum(additional_interests_paid_to_fh) AS platform
    FROM expected GROUP BY sku_id),
  level2b AS (
    SELECT {listed}
    FROM sku k JOIN merchant m ON m.merchant_id = k.merchant_id
    LEFT JOIN sold s ON s.sku_id = k.sku_id
    LEFT JOIN reported u ON u.sku_id = k.sku_id
    LEFT JOIN buckets c ON c.sku_id = k.sku_id),"""


_MAPPING = """
  owners AS (
    SELECT DISTINCT sku_id, merchant_name FROM (
      SELECT sku_id, merchant_name FROM sales UNION ALL SELECT sku_id, merchant_name FROM expected)),
  stale AS (
    SELECT 'old' AS note_id, sku_id, 'OLD-' || sku_id AS va_number, merchant_id FROM sku),
  replaced AS (
    SELECT * FROM stale WHERE sku_id NOT IN (SELECT sku_id FROM bridge)
    UNION ALL SELECT note_id, sku_id, va_number, merchant_id FROM bridge),
  known AS (SELECT s_name AS merchant_name FROM supplier WHERE s_nationkey >= 15),"""

_COUNTS = """
  raw_counts AS (
    SELECT 'external_accounts' AS tbl, count(*) AS cnt FROM external_text
    UNION ALL SELECT 'repmt_sales', count(*) FROM sales
    UNION ALL SELECT 'repmt_sku', count(*) FROM expected_text
    UNION ALL SELECT 'va_txn', count(*) FROM ledger_text)
"""

_PRELUDE = (
    "WITH"
    + _TABLES
    + _level1("level1", "'merchant_repayment'")
    + _level1("generous", "'merchant_repayment', 'funds_to_sku'")
    + _level2a()
    + _level2b()
    + _MAPPING
    + _COUNTS
)

_LEVEL1_AMOUNTS = {
    "amount_pulled": "amount_pulled",
    "amount_received": "amount_received",
    "variance_pulled_vs_received": "amount_pulled - amount_received",
    "sales_proceeds": "sales_proceeds",
    "variance_received_vs_sales": "sales_proceeds - amount_received",
}


def _level1_columns(headings: dict[str, str] | None = None) -> str:
    head = headings or {c: c for c in EXPORT_HEADINGS}
    keys = ", ".join(f'{c} AS "{head[c]}"' for c in ("sku_id", "account_number", "merchant"))
    return keys + ", " + ", ".join(_cents(e, head[c]) for c, e in _LEVEL1_AMOUNTS.items())


_YES_NO = [f"{b.flag} Paid > Expected?" for b in WATERFALL if b.flag] + [
    f"{b.flag} Settled?" for b in WATERFALL if b.flag
]
_LEVEL2A_AMOUNTS = [
    "Amount Received",
    "Amount Distributed Down the Repayment Waterfall",
    "Fund Transferred to Other SKU",
    "Variance",
    "Sales Proceeds",
    "Merchant Top Up",
    "Disbursement Surplus",
    "Fund Transferred from Other SKU",
    "Other",
    *[f"{b.name} {kind}" for kind in ("Paid", "Expected", "Outstanding") for b in WATERFALL],
]


def _level2a_columns(names: list[str]) -> str:
    plain = {"SKU ID", "Merchant", *_YES_NO}
    return ", ".join(f'"{n}"' if n in plain else _cents(f'"{n}"', n) for n in names)


def _first(group: str, rank: str) -> str:
    return (
        f"SELECT '{group}' AS group_by, sku_id, va_number, note_id FROM ranked WHERE {rank} = 1"
    )


_TOP = "abs(sales_proceeds - amount_received) DESC, sku_id, account_number NULLS LAST"

_PER_SKU_SOLD = "(SELECT max(sales_proceeds) AS sold FROM level1 GROUP BY sku_id)"
_TOTALS = f"""SELECT
    (SELECT coalesce(sum(amount_pulled), 0) FROM level1) AS mart_pulled,
    (SELECT coalesce(sum(e.buy_amount), 0) FROM external e
     JOIN bridge b ON b.va_number = e.va_number) AS raw_pulled,
    (SELECT coalesce(sum(amount_received), 0) FROM level1) AS mart_received,
    (SELECT coalesce(sum(signed_amount), 0) FROM flows WHERE direction = 'inflow'
     AND category_code = 'merchant_repayment') AS raw_received,
    (SELECT coalesce(sum(sold), 0) FROM {_PER_SKU_SOLD}) AS mart_sales,
    (SELECT coalesce(sum(sales_proceeds), 0) FROM sales) AS raw_sales"""
_SKUS = """SELECT
    (SELECT count(DISTINCT sku_id) FROM sales) AS raw,
    (SELECT count(DISTINCT sku_id) FROM level1) AS one,
    (SELECT count(DISTINCT "SKU ID") FROM level2a) AS two,
    (SELECT count(DISTINCT "SKU ID") FROM level2b) AS three,
    (SELECT count(DISTINCT sku_id) FROM bridge) AS mapped"""


def _plain_text(expression: str) -> str:
    return f"CAST(CAST(round({expression}, 2) AS DECIMAL(38,2)) AS VARCHAR)"


_CHECKS = {
    "raw_data": """SELECT 'raw_data' AS "check", 'fail' AS severity, sum(cnt) > 0 AS passed,
    sum(cnt)::BIGINT || ' raw rows' AS detail FROM raw_counts""",
    "coverage": f"""SELECT 'mapping_coverage' AS "check", 'warn' AS severity,
    raw = mapped AS passed, 'mapped=' || mapped || ' missing=' || (raw - mapped) AS detail
    FROM ({_SKUS})""",
    "row_counts": f"""SELECT 'mart_row_counts' AS "check", 'fail' AS severity,
    one = raw AND two = raw AND three = raw AS passed,
    'raw=' || raw || ' level1=' || one || ' level2a=' || two || ' level2b=' || three AS detail
    FROM ({_SKUS})""",
    "totals": f"""SELECT 'level1_totals' AS "check", 'fail' AS severity,
    abs(mart_pulled - raw_pulled) <= 0.01 AND abs(mart_received - raw_received) <= 0.01
      AND abs(mart_sales - raw_sales) <= 0.01 AS passed,
    'pulled ' || {_plain_text("mart_pulled")} || ' of ' || {_plain_text("raw_pulled")}
      || ', received ' || {_plain_text("mart_received")} || ' of ' || {_plain_text("raw_received")}
      || ', sales ' || {_plain_text("mart_sales")} || ' of ' || {_plain_text("raw_sales")}
      AS detail
    FROM ({_TOTALS})""",
    "tolerance": """SELECT 'level1_tolerance' AS "check", 'warn' AS severity,
    count(*) = 0 AS passed, count(*) || ' rows outside' AS detail
    FROM level1 WHERE amount_pulled - amount_received < -4.0
      OR amount_pulled - amount_received > 0.05 OR amount_pulled - amount_received > -2.05""",
}

_DIFFERENCES = """SELECT * FROM (
  WITH cells AS (
    SELECT sku_id, account_number, p, r, s, m, sum(e)::BIGINT AS e, sum(a)::BIGINT AS a FROM (
      SELECT sku_id, account_number, round(coalesce(amount_pulled, 0), 2) AS p,
        round(coalesce(amount_received, 0), 2) AS r, round(coalesce(sales_proceeds, 0), 2) AS s,
        merchant AS m, 1 AS e, 0 AS a FROM generous
      UNION ALL SELECT sku_id, account_number, round(coalesce(amount_pulled, 0), 2),
        round(coalesce(amount_received, 0), 2), round(coalesce(sales_proceeds, 0), 2),
        merchant, 0, 1 FROM level1) GROUP BY ALL
  ), amounts AS (
    SELECT sku_id, account_number, sum(e) AS e, sum(a) AS a, sum(least(e, a)) AS same
    FROM cells GROUP BY sku_id, account_number, p, r, s
  ), keys AS (
    SELECT sku_id, account_number, sum(e - least(e, a)) AS missed, sum(a - least(e, a)) AS added,
      sum(least(e, a) - same) AS renamed FROM amounts GROUP BY sku_id, account_number
  )
  SELECT sku_id, account_number, problem FROM (SELECT *, unnest(range(n::BIGINT)) FROM (
    SELECT sku_id, account_number, 'missing' AS problem, missed - least(missed, added) AS n FROM keys
    UNION ALL SELECT sku_id, account_number, 'extra', added - least(missed, added) FROM keys
    UNION ALL SELECT sku_id, account_number, 'amount', least(missed, added) FROM keys
    UNION ALL SELECT sku_id, account_number, 'merchant', renamed FROM keys)))"""


def _count_of(problem: str) -> str:
    return f"'{problem}=' || count(*) FILTER (problem = '{problem}')"


_FLOW_COLUMNS = (
    "va_number, sku_id, merchant_id, category_code, direction, "
    + _cents("raw_amount", "raw_amount")
    + ", "
    + _cents("signed_amount", "signed_amount")
)
_PIVOT_COLUMNS = ", ".join(_cents(c, c) for c in ("amount_received", *PAID_CODES))
_CATEGORISED = f"""SELECT l.sender_va, l.receiver_va, {_cents("l.amount", "amount")}, l.remarks,
    coalesce(r.category_code, 'uncategorized') AS category_code
  FROM ledger l LEFT JOIN best_rule r ON r.remark = l.remarks"""
_MOVED = f"""SELECT sku_id, merchant_id, {_cents("moved_out", "transfer_out_to_other_sku")},
    {_cents("moved_in", "transfer_in_from_other_sku")} FROM moved"""
_PERIOD = "strftime(day, '%Y-%m') AS period_ym"
def _in_order(rows: str, first: list[str], rest: list[str]) -> str:
    order = [*first, *[c for c in rest if c not in first]]
    keys = ", ".join(f'"{c}" NULLS LAST' for c in order)
    return f"SELECT row_number() OVER (ORDER BY {keys}) AS position, * FROM ({rows})"


_TYPED_SALES = f"""SELECT merchant_name, sku_id,
      {", ".join(_cents(m, m) for m in ("total_funds_inflow", "sales_proceeds", "l2e"))},
      {_cents("0", "merchant_top_up")}, {_cents("0", "disbursement_surplus")} FROM sales"""

_RESULTS = {
    "safe_numeric": f"""SELECT sender_va AS va_number, {_cents("sum(amount)", "amount")},
      count(amount) AS n_parsed FROM ledger GROUP BY sender_va""",
    "safe_date": f"""SELECT date_text, {_iso(_day("date_text"), "day")}, count(*) AS n
      FROM ledger_text GROUP BY date_text""",
    "period_totals": f"""SELECT {_PERIOD}, {_cents("sum(buy_amount)", "buy_amount")},
      count(*) AS n FROM external GROUP BY 1""",
    "accounting_parse": "SELECT merchant, "
    + ", ".join(
        _cents(f"sum({_accounting(m)})", m)
        for m in REPAYMENT_MEASURES
    )
    + " FROM expected_text GROUP BY merchant",
    "header_keys": """SELECT DISTINCT remark_text AS raw,
      trim(regexp_replace(lower(remark_text), '[^a-z0-9]+', ' ', 'g')) AS normalised
      FROM ledger_text""",
    "merchant_norm": """SELECT merchant_id, merchant_name,
      lower(regexp_replace(merchant_name, '\\s+', ' ', 'g')) AS merchant_name_norm FROM merchant""",
    "typed_external": f"""SELECT va_number, {_cents("buy_amount", "buy_amount")}, buy_currency,
      {_iso("day", "created_at_utc")}, {_PERIOD} FROM external""",
    "typed_expected": "SELECT merchant_name, sku_id, "
    + ", ".join(
        _cents(m, m)
        for m in (
            *REPAYMENT_MEASURES,
            "additional_admin_fee_expected",
            "sr_add_interest_expected",
            "jr_add_interest_expected",
        )
    )
    + " FROM expected",
    "typed_sales": _TYPED_SALES,
    "canonical_sales": _TYPED_SALES,
    "feed_lines": """SELECT 'Supplier "' || p_partkey || '",' || chr(10) || 'of ' AS merchant,
      'S' || p_partkey AS sku_id, p_size::VARCHAR AS total_funds_inflow,
      p_partkey::VARCHAR AS sales_proceeds,
      CASE WHEN p_size % 3 = 0 THEN chr(10) || p_partkey || chr(10) || chr(10) END AS l2e FROM part""",
    "report_block": """SELECT CAST(NULL AS VARCHAR) AS note_id, 'SKU-' || p_partkey AS sku_id,
      'VA-' || p_partkey AS va_number FROM part""",
    "golden_rows": f"""SELECT 'SKU-' || o_orderkey AS sku_id, 'VA-' || o_orderkey AS account_number,
      CASE WHEN o_custkey % 3 = 0 THEN 'M "' || o_custkey || '",' || chr(10) || 'and "sons"'
        ELSE 'M-' || o_custkey END AS merchant, {_cents("o_totalprice", "amount_pulled")},
      {_cents("CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END", "amount_received")},
      {_cents("CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey END", "sales_proceeds")}
      FROM orders WHERE o_orderstatus <> 'O'""",
    "check_headers": """SELECT 'csv_headers' AS "check", 'fail' AS severity, false AS passed,
      'header mismatch: repmt_sku' AS detail""",
    "typed_ledger": f"""SELECT 'S-' || l_suppkey AS sender_virtual_account_id, sender_va,
      CAST(NULL AS VARCHAR) AS sender_note_id, 'R-' || l_partkey AS receiver_virtual_account_id,
      receiver_va, CAST(NULL AS VARCHAR) AS receiver_note_id,
      {_cents(_number(_price("l_quantity")), "r_opening_bal")},
      {_cents("NULL", "r_closing_bal")}, {_cents(_number("amount_text"), "amount")},
      {_iso(_day("date_text"), "occurred_at_utc")},
      strftime({_day("date_text")}, '%Y-%m') AS period_ym,
      lower(trim(coalesce(remark_text, ''))) AS remarks FROM ledger_text""",
    "categorise_case": _CATEGORISED,
    "categorise_join": _CATEGORISED,
    "categorise_posix": r"""SELECT remarks, CASE
        WHEN regexp_matches(remarks, '^[[:space:]]*merchant-[[:alpha:]]+[[:space:]]*$') THEN 'padded'
        WHEN regexp_matches(remarks, '\bint') THEN 'begins int'
        WHEN regexp_matches(remarks, '\bsku\b') THEN 'a sku'
        WHEN regexp_matches(remarks, 'fee\b') THEN 'ends fee'
        WHEN regexp_matches(remarks, '\binterest\b.*\bprincipal\b') THEN 'both'
        WHEN regexp_matches(remarks, '^[^0-9 \t]{3,}-[[:alnum:]]+-[a-z]{4,8}') THEN 'dashes'
        WHEN regexp_matches(remarks, '(jr|sr) ') THEN 'short'
        WHEN contains(remarks, 'b') THEN 'a letter' ELSE 'uncategorized' END AS category_code,
      count(*) AS n
      FROM (SELECT lower(coalesce(remark_text, '')) AS remarks FROM ledger_text) GROUP BY ALL""",
    "va_txn": f"""SELECT va_number, sku_id, merchant_id, category_code,
      {_cents("amount", "amount")}, {_iso("day", "occurred_at_utc")}, {_PERIOD}, remarks
      FROM txn""",
    "category_breakdown": "SELECT category_code, count(*) AS n FROM txn GROUP BY category_code",
    "va_txn_flows": f"""SELECT {_FLOW_COLUMNS}, {_iso("day", "occurred_at_utc")}, {_PERIOD},
      remarks FROM flows""",
    "flow_totals": f"""SELECT b.va_number, b.sku_id, b.merchant_id, t.category_code, t.direction,
      {_cents("t.amount", "raw_amount")},
      {_cents("CASE t.direction WHEN 'inflow' THEN t.amount ELSE -t.amount END", "signed_amount")},
      t.n AS n_rows
      FROM bridge b JOIN (
        SELECT account, direction, category_code, sum(amount) AS amount, count(*) AS n FROM (
          SELECT receiver_va AS account, 'inflow' AS direction, amount, remarks FROM ledger
          UNION ALL SELECT sender_va, 'outflow', amount, remarks FROM ledger) x
        LEFT JOIN (SELECT remark, category_code AS code FROM best_rule) r ON r.remark = x.remarks
        CROSS JOIN LATERAL (SELECT coalesce(r.code, 'uncategorized') AS category_code) c
        GROUP BY account, direction, category_code) t ON t.account = b.va_number""",
    "flow_summary": f"""SELECT sku_id, category_code, direction, count(*) AS n,
      {_cents("sum(signed_amount)", "sum_signed")}
      FROM flows GROUP BY sku_id, category_code, direction""",
    "flows_pivot": f"SELECT sku_id, merchant_id, {_PIVOT_COLUMNS} FROM buckets",
    "received": f"""SELECT sku_id, va_number AS account_number,
      {_cents("amount", "amount_received")} FROM level1_received""",
    "inter_sku_transfers": f"""SELECT sender_va, receiver_va, {_cents("amount", "amount")},
      {_iso("day", "occurred_at_utc")}, from_sku_id, from_merchant_id, to_sku_id, to_merchant_id,
      {_PERIOD} FROM transfers""",
    "transfers_agg": _MOVED,
    "transfer_totals": _MOVED,
    "latest_transfers": f"""SELECT from_sku_id AS sku_from, to_sku_id AS sku_to,
      {_cents("amount", "amount")}, {_iso("day", "occurred_at_utc")}, {_PERIOD}
      FROM (SELECT * FROM transfers ORDER BY day DESC NULLS FIRST, from_sku_id, to_sku_id,
        amount NULLS LAST LIMIT 50)""",
    "first_rows": _first("sku_id", "sku_va_rank")
    + " UNION ALL "
    + _first("va_number", "va_sku_rank"),
    "level1": f"SELECT {_level1_columns()} FROM level1",
    "level1_export": f"SELECT {_level1_columns(EXPORT_HEADINGS)} FROM level1",
    "level1_in_order": _in_order(
        f"SELECT {_level1_columns(EXPORT_HEADINGS)} FROM level1",
        ["SKU ID", "Account Number", "Merchant"],
        list(EXPORT_HEADINGS.values()),
    ),
    "level2a_in_order": _in_order(
        f"SELECT {_level2a_columns(PREVIEW_COLUMNS)} FROM level2a", ["SKU ID", "Merchant"], PREVIEW_COLUMNS
    ),
    "rules_in_order": _in_order(
        """SELECT raw_pattern, category_code, is_regex, priority FROM rules
      UNION ALL SELECT 'brand#10', 'brand', true, 5
      UNION ALL SELECT DISTINCT lower(p_brand), 'brand', false, 90 FROM part
      WHERE p_brand <> 'Brand#10'""",
        ["priority", "raw_pattern", "category_code"],
        [],
    ),
    "level1_top_variance": f"""SELECT sku_id, merchant,
      {", ".join(_cents(c, c) for c in ("amount_pulled", "amount_received", "sales_proceeds"))},
      {_cents("sales_proceeds - amount_received", "variance_sales")}
      FROM (SELECT * FROM level1 ORDER BY {_TOP} LIMIT 20)""",
    "variance_overview": f"""SELECT sku_id,
      {_cents("amount_pulled - amount_received", "variance_cash")},
      {_cents("sales_proceeds - amount_received", "variance_ui")}, merchant
      FROM (SELECT * FROM level1 ORDER BY {_TOP} LIMIT 10)""",
    "level1_lookup": f"""SELECT {_level1_columns()} FROM level1
      WHERE sku_id = 'SKU-7' AND account_number = 'VA-7'""",
    "level1_count": "SELECT count(*) AS level1_rows FROM level1",
    "merchant_rollup": f"""SELECT merchant, {_cents("sum(amount_pulled)", "total_pulled")},
      {_cents("sum(amount_received)", "total_received")},
      {_cents("sum(sales_proceeds)", "total_sales")} FROM level1 GROUP BY merchant""",
    "level2a": "SELECT "
    + _level2a_columns(["SKU ID", "Merchant", *_YES_NO, *_LEVEL2A_AMOUNTS])
    + " FROM level2a",
    "level2a_preview": f"""SELECT {_level2a_columns(PREVIEW_COLUMNS)}
      FROM (SELECT * FROM level2a ORDER BY "SKU ID" NULLS LAST, "Merchant" NULLS LAST
        LIMIT 100)""",
    "level2b": "SELECT * FROM level2b",
    "drilldown": f"""SELECT l.sku_id, {_cents("s.inflow", "csv_total_funds_inflow")},
      {_cents("s.amount", "csv_sales_proceeds")}, {_cents("l.amount_pulled", "amount_pulled")},
      {_cents("l.amount_received", "amount_received")},
      {_cents("l.sales_proceeds", "sales_proceeds")},
      {_cents('a."Amount Received"', "l2a_amount_received")},
      {_cents(" + ".join(f'a."{c}"' for c in PREVIEW_COLUMNS if c.endswith(" Paid")),
              "l2a_total_paid")},
      {_cents('a."Fund Transferred to Other SKU"', "Fund Transferred to Other SKU")},
      {_cents('a."Fund Transferred from Other SKU"', "Fund Transferred from Other SKU")}
      FROM level1 l LEFT JOIN sold s ON s.sku_id = l.sku_id
      LEFT JOIN level2a a ON a."SKU ID" = l.sku_id WHERE l.sku_id LIKE 'SKU-%'""",
    "insert_ignore": """SELECT coalesce(s.sku_id, e.sku_id) AS sku_id,
      CASE WHEN s.sku_id IS NULL THEN 'expected' ELSE 'sales' END AS origin
      FROM (SELECT DISTINCT sku_id FROM sales) s
      FULL JOIN (SELECT DISTINCT sku_id FROM expected) e ON e.sku_id = s.sku_id""",
    "upsert": """SELECT coalesce(s.sku_id, e.sku_id) AS sku_id,
      CASE WHEN e.sku_id IS NULL THEN 'sales' ELSE 'expected' END AS origin
      FROM (SELECT DISTINCT sku_id FROM sales) s
      FULL JOIN (SELECT DISTINCT sku_id FROM expected) e ON e.sku_id = s.sku_id""",
    "replace_by": "SELECT * FROM replaced",
    "load_mapping": "SELECT * FROM replaced",
    "load_mapping_skus": """SELECT DISTINCT sku_id, merchant_id FROM bridge
      UNION ALL
      SELECT 'GONE-' || sku_id, merchant_id FROM sku
      UNION ALL
      SELECT 'SKU-' || p_partkey, sha256('Supplier#000000000') FROM part
      WHERE p_partkey % 3 > 0 AND 'SKU-' || p_partkey NOT IN (SELECT sku_id FROM bridge)""",
    "upsert_merchants": """SELECT sha256(merchant_name) AS merchant_id, merchant_name,
      lower(merchant_name) AS merchant_name_norm
      FROM (SELECT merchant_name FROM known UNION SELECT merchant_name FROM sales)""",
    "upsert_skus": """SELECT k.sku_id, k.merchant_id FROM sku k
      WHERE k.sku_id NOT IN (SELECT sku_id FROM expected)
      UNION
      SELECT s.sku_id, m.merchant_id FROM sales s
      JOIN merchant m ON lower(m.merchant_name) = lower(s.merchant_name)""",
    "add_bridge_rows": """SELECT note_id, sku_id, va_number, merchant_id FROM bridge
      UNION ALL
      SELECT v.note_id, v.sku_id, v.va_number, m.merchant_id
      FROM (VALUES ('44', 'SKU-1', 'VA-1'), ('44', 'SKU-1', 'VA-2'), ('N2', 'SKU-1', 'VA-1'))
        v(note_id, sku_id, va_number)
      JOIN merchant m ON m.merchant_name = 'Supplier#000000001'
      WHERE (v.note_id, v.sku_id, v.va_number) NOT IN
        (SELECT (note_id, sku_id, va_number) FROM bridge WHERE note_id IS NOT NULL)""",
    "validated_mapping": """SELECT b.note_id, b.sku_id, b.va_number, m.merchant_id
      FROM bridge b LEFT JOIN owners o ON o.sku_id = b.sku_id
      LEFT JOIN merchant m ON lower(m.merchant_name) = lower(o.merchant_name)""",
    "mapping_counts": """SELECT count(*) AS mappings_loaded,
      count(DISTINCT sku_id) AS distinct_skus FROM bridge""",
    "sku_coverage": """SELECT (SELECT count(*) FROM sku) AS ref_sku_count,
      (SELECT count(DISTINCT sku_id) FROM sales) AS sales_sku_count""",
    "check_coverage": _CHECKS["coverage"],
    "check_row_counts": _CHECKS["row_counts"],
    "check_totals": _CHECKS["totals"],
    "check_tolerance": _CHECKS["tolerance"],
    "check_suite": " UNION ALL ".join(_CHECKS.values()),
    "check_parity": f"""SELECT 'level1_parity' AS "check", 'fail' AS severity,
      count(*) = 0 AS passed, {" || ' ' || ".join(
          _count_of(p) for p in ("missing", "extra", "amount", "merchant"))} AS detail
      FROM ({_DIFFERENCES})""",
    "parity_differences": _DIFFERENCES,
    "parity_removed": """SELECT 'SKU-' || l_partkey AS sku_id,
      CASE WHEN l_partkey % 50 <> 0 THEN 'VA-' || l_partkey END AS account_number,
      'missing' AS problem FROM lineitem WHERE l_linenumber = 3""",
    "parity_self": "SELECT sku_id, account_number, '' AS problem FROM level1 WHERE false",
    "key_differences": """SELECT coalesce(s.sku_id, e.sku_id) AS sku_id,
      CASE WHEN e.sku_id IS NULL THEN 'left' ELSE 'right' END AS found_in
      FROM (SELECT DISTINCT sku_id FROM sales) s
      FULL JOIN (SELECT DISTINCT sku_id FROM expected) e ON e.sku_id = s.sku_id
      WHERE s.sku_id IS NULL OR e.sku_id IS NULL""",
    "outside_band": f"""SELECT {_level1_columns()} FROM level1
      WHERE NOT (amount_pulled - amount_received BETWEEN -4.00 AND 0.05)""",
    "unmapped_skus": """SELECT DISTINCT sku_id FROM sales
      WHERE sku_id NOT IN (SELECT sku_id FROM bridge)""",
    "exists_in": """SELECT note_id, sku_id, va_number,
      va_number IN (SELECT va_number FROM external) AS exists_in_external FROM bridge""",
    "exists_in_with_null": """SELECT note_id, sku_id, va_number,
      va_number IN (SELECT nullif(va_number, 'VA-1') FROM external) AS exists_in_external
      FROM bridge""",
    "unread_cells": f"""SELECT 'va_txn' AS feed,
        count(*) FILTER (amount_text IS NOT NULL AND {_number("amount_text")} IS NULL) AS amounts,
        count(*) FILTER (date_text IS NOT NULL AND {_day("date_text")} IS NULL) AS dates
      FROM ledger_text
      UNION ALL
      SELECT 'external_accounts', count(*) FILTER (amount IS NOT NULL AND {_number("amount")} IS NULL),
        count(*) FILTER (created IS NOT NULL AND {_day("created")} IS NULL) FROM external_text""",
    "add_rules": """SELECT raw_pattern, category_code, is_regex, priority FROM rules
      UNION ALL SELECT 'brand#10', 'brand', true, 5
      UNION ALL SELECT DISTINCT lower(p_brand), 'brand', false, 90 FROM part
      WHERE p_brand <> 'Brand#10'""",
    "chain_status": """SELECT (SELECT count(*) FROM bridge) AS map_rows,
      (SELECT count(*) FROM external) AS external_rows, (SELECT count(*) FROM sales) AS sales_rows,
      (SELECT count(*) FROM txn WHERE category_code = 'merchant_repayment') AS inflow_rows,
      (SELECT count(*) FROM level1) AS level1_rows""",
    "raw_counts": "SELECT * FROM raw_counts",
    "total_rows": "SELECT CAST(sum(cnt) AS BIGINT) AS total_rows FROM raw_counts",
    "remark_audit": """SELECT lower(remark_text) AS remark, count(*) AS n FROM ledger_text
      GROUP BY 1 ORDER BY n DESC, remark NULLS LAST LIMIT 50""",
    "top_pulled": f"""SELECT va_number, {_cents("amount", "pulled")}
      FROM (SELECT * FROM pulled ORDER BY amount DESC NULLS FIRST, va_number LIMIT 20)""",
}

# What comes through files is what went into them.
_RESULTS |= {
    "accounts_from_files": _RESULTS["typed_external"],
    "repayments_from_files": _RESULTS["typed_expected"],
    "ledger_from_files": _RESULTS["typed_ledger"],
}


def oracles() -> dict[str, str]:
    return {name: f"{_PRELUDE}\n{query}" for name, query in _RESULTS.items()}
