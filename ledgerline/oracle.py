"""SQL counterparts of the registered queries, for an independent engine on the same tables.

Each text stands alone: the shared views are prepended as common table expressions. Money stays
decimal; averages and ratios are one division of exact sums, as in the Spark queries.
"""

AS_OF = "2001-01-01"


def source_views(as_of=AS_OF, prefix=""):
    """Raw finance tables over the star schema."""
    return f"""
{prefix}priced AS (
  SELECT *,
    cast(l_quantity AS integer) AS q,
    cast(l_shipdate AS date) AS invoice_date,
    [7, 14, 30, 60][1 + l_suppkey % 4] AS terms,
    round(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2))), 2)::decimal(18,2) AS excl,
    (l_linestatus = 'F' OR l_returnflag <> 'R') AS paid,
    CASE WHEN cast(l_tax AS decimal(4,2)) >= 0.08 THEN 0.14 ELSE 0.15 END AS rate
  FROM lineitem
),
{prefix}dated AS (
  SELECT *, round(excl * rate, 2)::decimal(18,2) AS vat, invoice_date + terms AS due,
    CASE WHEN NOT paid THEN NULL
         WHEN q > 40 THEN invoice_date + terms + (q - 40)
         ELSE invoice_date + terms - (q % 5 + 1) END AS pay
  FROM {prefix}priced
),
{prefix}raw_invoices AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, q) AS invoice_id,
    cast(l_suppkey AS varchar) AS supplier_id,
    invoice_date, due AS due_date, pay AS payment_date,
    excl AS amount_excl_vat, vat AS vat_amount, (excl + vat)::decimal(18,2) AS amount_incl_vat,
    'ZAR' AS currency,
    ['Office Supplies', 'IT Equipment', 'Cleaning Services', 'Courier Services', 'Legal Services',
     'Accounting Services', 'Marketing', 'Security Services', 'Maintenance', 'Catering'][1 + l_suppkey % 10] AS category,
    terms AS payment_terms_days,
    greatest(0, coalesce(pay, DATE '{as_of}') - due)::integer AS days_past_due,
    (paid AND q > 40) AS is_late, paid AS is_paid,
    CASE WHEN paid THEN 'Paid' WHEN DATE '{as_of}' > due THEN 'Overdue' ELSE 'Pending' END AS invoice_status
  FROM {prefix}dated
),
{prefix}inv AS (
  SELECT
    invoice_id, supplier_id, invoice_date, due_date, payment_date,
    CASE WHEN amount_excl_vat > 0 THEN amount_excl_vat END AS amount_excl_vat,
    CASE WHEN vat_amount >= 0 THEN vat_amount END AS vat_amount,
    CASE WHEN amount_incl_vat > 0 THEN amount_incl_vat END AS amount_incl_vat,
    CASE WHEN abs(vat_amount - amount_excl_vat * 0.15) < 0.02 THEN 'VALID' ELSE 'VAT_MISMATCH' END AS vat_validation_status,
    currency, category,
    CASE WHEN payment_terms_days > 0 THEN payment_terms_days END AS payment_terms_days,
    days_past_due, is_late, is_paid,
    CASE WHEN invoice_status IN ('Paid', 'Overdue', 'Pending') THEN upper(invoice_status) ELSE 'UNKNOWN' END AS invoice_status
  FROM {prefix}raw_invoices
  WHERE invoice_id IS NOT NULL AND supplier_id IS NOT NULL AND amount_incl_vat > 0
)"""


OTHER_VIEWS = """,
raw_suppliers AS (
  SELECT
    cast(s_suppkey AS varchar) AS supplier_id, s_name AS supplier_name,
    concat(1990 + s_suppkey % 33, '/', cast(s_suppkey + 100000 AS varchar), '/',
           ['07', '08', '23'][1 + s_suppkey % 3]) AS cipc_number,
    concat('4', lpad(cast(s_suppkey AS varchar), 9, '0')) AS vat_number,
    ['Office Supplies', 'IT Equipment', 'Cleaning Services', 'Courier Services', 'Legal Services',
     'Accounting Services', 'Marketing', 'Security Services', 'Maintenance', 'Catering'][1 + s_suppkey % 10] AS category,
    [7, 14, 30, 60][1 + s_suppkey % 4] AS payment_terms_days,
    abs(cast(s_acctbal AS decimal(18,2)))::decimal(18,2) AS avg_invoice_value_zar,
    round(0.10 + abs(cast(s_acctbal AS decimal(18,2))) * 0.00003, 3)::decimal(6,4) AS late_payment_probability,
    concat(' Accounts.', s_suppkey, '@Example.com ') AS email,
    n_name AS city,
    cast(DATE '1990-01-01' + cast(s_suppkey % 1500 AS integer) AS timestamp) AS created_at
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
sup AS (
  SELECT supplier_id, upper(trim(supplier_name)) AS supplier_name, cipc_number, vat_number,
    upper(trim(category)) AS category, payment_terms_days, avg_invoice_value_zar,
    late_payment_probability, lower(trim(email)) AS email, trim(city) AS city, created_at
  FROM raw_suppliers WHERE supplier_id IS NOT NULL AND supplier_name IS NOT NULL
),
raw_bank AS (
  SELECT 'PAY-' || invoice_id AS transaction_id, payment_date AS transaction_date,
    'EFT Payment - ' || invoice_id AS description, amount_incl_vat AS debit_amount,
    0::decimal(18,2) AS credit_amount, (-amount_incl_vat)::decimal(18,2) AS balance_impact,
    'Supplier Payment' AS category, invoice_id AS invoice_reference, true AS reconciled
  FROM raw_invoices WHERE is_paid
  UNION ALL
  SELECT 'RCV-' || o_orderkey, cast(o_orderdate AS date), 'Customer payment received',
    0::decimal(18,2), cast(o_totalprice AS decimal(18,2)), cast(o_totalprice AS decimal(18,2)),
    'Revenue', NULL, o_orderstatus <> 'P'
  FROM orders
),
bank AS (
  SELECT transaction_id, transaction_date, trim(description) AS description, debit_amount,
    credit_amount, balance_impact, upper(trim(category)) AS category, invoice_reference, reconciled
  FROM raw_bank
  WHERE transaction_id IS NOT NULL AND transaction_date IS NOT NULL AND (debit_amount > 0 OR credit_amount > 0)
),
joined AS (
  SELECT i.*, s.supplier_name, s.cipc_number, s.vat_number, s.category AS supplier_category,
    s.payment_terms_days AS supplier_payment_terms_days, s.avg_invoice_value_zar,
    s.late_payment_probability, s.email, s.city, s.created_at
  FROM inv i LEFT JOIN sup s ON i.supplier_id = s.supplier_id
),
paid AS (
  SELECT *, payment_date - invoice_date AS actual_days,
    payment_date - invoice_date - payment_terms_days AS days_delta,
    CASE WHEN payment_date - invoice_date - payment_terms_days < -2 THEN 'Early'
         WHEN payment_date - invoice_date - payment_terms_days <= 2 THEN 'On-time' ELSE 'Late' END AS compliance
  FROM inv WHERE invoice_status = 'PAID' AND payment_date IS NOT NULL
),
labelled AS (
  SELECT *, is_late::integer AS label, late_payment_probability::double AS score FROM joined WHERE is_paid
)"""

VIEWS = "WITH" + source_views() + OTHER_VIEWS

# Faults by rule in the raw tables, before they are cleaned.
FAULTY_INVOICES = """raw_invoices AS (
  SELECT CASE WHEN k <> 13 THEN invoice_id END AS invoice_id,
    CASE WHEN k = 0 THEN 'X' || supplier_id WHEN k <> 5 THEN supplier_id END AS supplier_id,
    CASE WHEN k = 15 THEN DATE '2030-01-01' WHEN k <> 9 THEN invoice_date END AS invoice_date,
    CASE WHEN k = 2 THEN invoice_date - 1 ELSE due_date END AS due_date, payment_date,
    amount_excl_vat, vat_amount,
    (CASE WHEN k = 4 THEN -amount_incl_vat WHEN k = 16 THEN amount_incl_vat + 1 ELSE amount_incl_vat END)::decimal(18,2)
      AS amount_incl_vat,
    CASE WHEN k = 1 THEN 'USD' WHEN k <> 8 THEN currency END AS currency,
    category, payment_terms_days, days_past_due, is_late, is_paid,
    CASE WHEN k = 3 THEN 'Void' WHEN k <> 6 THEN invoice_status END AS invoice_status
  FROM (SELECT *, cast(split_part(invoice_id, '-', 1) AS bigint) % 40 AS k FROM clean_invoices) c,
    (VALUES (0), (1)) AS t(copy)
  WHERE copy = 0 OR k = 7
),
inv AS ("""
FAULTY_SUPPLIERS = """raw_suppliers AS (
  SELECT CASE WHEN k = 9 THEN 'U' || supplier_id ELSE supplier_id END AS supplier_id,
    CASE WHEN k <> 6 THEN supplier_name END AS supplier_name,
    CASE WHEN k = 3 THEN 'BAD' ELSE cipc_number END AS cipc_number,
    CASE WHEN k = 4 THEN '999' ELSE vat_number END AS vat_number, category,
    CASE WHEN k = 5 THEN 45 ELSE payment_terms_days END AS payment_terms_days,
    avg_invoice_value_zar, late_payment_probability, email, city, created_at
  FROM (SELECT *, cast(supplier_id AS bigint) % 20 AS k FROM clean_suppliers) WHERE k <> 7
),
sup AS ("""
FAULTY_BANK = """
raw_bank AS (
  SELECT transaction_id, CASE WHEN k <> 14 THEN transaction_date END AS transaction_date, description,
    (CASE WHEN k = 11 THEN debit_amount + 5 ELSE debit_amount END)::decimal(18,2) AS debit_amount,
    credit_amount, balance_impact, category,
    CASE WHEN k = 10 THEN 'GONE-' || invoice_reference WHEN k <> 12 THEN invoice_reference END AS invoice_reference,
    CASE WHEN k IN (10, 12) THEN false ELSE reconciled END AS reconciled
  FROM (SELECT *, coalesce(cast(split_part(invoice_reference, '-', 1) AS bigint) % 40, -1) AS k FROM clean_bank)
),
bank AS ("""


def with_faults(views, *tables):
    if "invoices" in tables:
        views = views.replace("raw_invoices AS (", "clean_invoices AS (").replace("inv AS (", FAULTY_INVOICES, 1)
    if "suppliers" in tables:
        views = views.replace("raw_suppliers AS (", "clean_suppliers AS (").replace("sup AS (", FAULTY_SUPPLIERS, 1)
    if "bank" in tables:
        views = views.replace("raw_bank AS (", "clean_bank AS (").replace("\nbank AS (", FAULTY_BANK, 1)
        if "invoices" in tables:
            views = views.replace("FROM raw_invoices WHERE is_paid", "FROM clean_invoices WHERE is_paid")
    return views


ALL_FAULTY = with_faults(VIEWS, "invoices", "suppliers", "bank")
FAULTY_LEDGER = with_faults(VIEWS, "bank")

MISMATCH = (
    "coalesce(abs(vat_amount::double - round_even(amount_excl_vat::double * 0.15::double * 100, 0) / 100)"
    " >= 0.02::double, true)"
)


# Classes of the paid invoices with their test share; columns of the feature matrix.
CLASSES = """
, c AS (
  SELECT label, count(*) AS n, floor(count(*) * 0.2 + 0.5)::bigint AS n_test FROM labelled GROUP BY 1
)"""
FEATURE_COUNT = "(SELECT 13 + count(DISTINCT category) FROM labelled)::integer"


def over_views(text):
    """Query text that may start with further common table expressions, as ``, name AS (...)``."""
    return VIEWS + "\n" + text.strip()


def stepwise(text):
    """For texts with a view that is built row by row from itself."""
    return text.replace("WITH", "WITH RECURSIVE", 1)


def over_faulty(text, views=None):
    return (views or ALL_FAULTY) + "\n" + text.strip()


def over_faulty_ledger(text):
    return over_faulty(text, FAULTY_LEDGER)


def ratio(part, whole):
    return f"(({part})::double / nullif(({whole})::double, 0))"


def mean_money(c):
    """Average in whole cents, half up, by integer arithmetic."""
    cents = f"sum(cast({c} * 100 AS hugeint))"
    return f"(((2 * {cents} + count({c})) // (2 * count({c}))) / 100.0)::decimal(18,2)"


def status_counts(views, table):
    return f"""{views}
SELECT invoice_status, count(*) AS invoices, sum(amount_incl_vat)::decimal(28,2) AS total,
  sum(days_past_due)::bigint AS days
FROM {table} GROUP BY 1"""


def checks(*entries):
    """Report rows: (name, table, column, severity, source, failing condition)."""
    parts = []
    for name, table, column, severity, source, failing in entries:
        bad = "WARN" if severity == "warn" else "FAIL"
        parts.append(
            f"SELECT '{name}' AS check_name, '{table}' AS \"table\", '{column}' AS \"column\", "
            f"'{severity}' AS severity, count(*) AS rows_checked, "
            f"count(*) FILTER (WHERE {failing}) AS failing_rows, "
            f"CASE WHEN count(*) FILTER (WHERE {failing}) = 0 THEN 'PASS' ELSE '{bad}' END AS status "
            f"FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def unique(table, column, severity, source):
    bad = "WARN" if severity == "warn" else "FAIL"
    return (
        f"SELECT 'unique' AS check_name, '{table}' AS \"table\", '{column}' AS \"column\", "
        f"'{severity}' AS severity, coalesce(sum(n), 0)::bigint AS rows_checked, "
        f"count(*) FILTER (WHERE n > 1) AS failing_rows, "
        f"CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'PASS' ELSE '{bad}' END AS status "
        f"FROM (SELECT {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    )


NOT_NULL = [
    ("not_null", "silver_invoices", c, "error", "inv", f"{c} IS NULL")
    for c in ["invoice_id", "supplier_id", "invoice_status", "amount_incl_vat"]
]
NOT_NULL_SUPPLIERS = [
    ("not_null", "silver_suppliers", c, "error", "sup", f"{c} IS NULL")
    for c in ["supplier_id", "supplier_name"]
]
NOT_NULL_BANK = [
    ("not_null", "silver_bank_transactions", c, "error", "bank", f"{c} IS NULL")
    for c in ["transaction_id", "transaction_date"]
]
ACCEPTED = [
    (
        "accepted_values",
        "silver_invoices",
        "invoice_status",
        "error",
        "inv",
        "invoice_status NOT IN ('PAID', 'OVERDUE', 'PENDING', 'UNKNOWN')",
    ),
    (
        "accepted_values",
        "silver_invoices",
        "vat_validation_status",
        "error",
        "inv",
        "vat_validation_status NOT IN ('VALID', 'VAT_MISMATCH')",
    ),
]
CURRENCY = (
    "currency_is_zar",
    "silver_invoices",
    "currency",
    "error",
    "inv",
    "currency IS DISTINCT FROM 'ZAR'",
)
VAT_ACCURACY = (
    "vat_accuracy",
    "silver_invoices",
    "vat_validation_status",
    "warn",
    "inv",
    "vat_validation_status <> 'VALID'",
)
UNIQUE_WARN = (
    unique("silver_invoices", "supplier_id", "warn", "inv")
    + "\nUNION ALL\n"
    + unique("silver_suppliers", "supplier_id", "warn", "sup")
)


RAW_NAMES = {"inv": "raw_invoices", "sup": "raw_suppliers", "bank": "raw_bank"}


def on_raw(entries):
    return [(*e[:4], RAW_NAMES[e[4]], e[5]) for e in entries]


def vat_months(day, condition):
    return f"""
SELECT strftime({day}, '%Y-%m') AS year_month, year({day})::integer AS year, month({day})::integer AS month,
  count(*) AS invoice_count,
  sum(amount_excl_vat)::decimal(28,2) AS total_excl_vat,
  sum(vat_amount)::decimal(28,2) AS total_vat_input_tax,
  sum(amount_incl_vat)::decimal(28,2) AS total_incl_vat,
  count(*) FILTER (WHERE invoice_status = 'PAID') AS paid_count,
  count(*) FILTER (WHERE invoice_status = 'OVERDUE') AS overdue_count,
  coalesce(sum(amount_incl_vat) FILTER (WHERE invoice_status = 'OVERDUE'), 0)::decimal(28,2) AS overdue_amount_zar,
  coalesce(sum(vat_amount) FILTER (WHERE invoice_status = 'PAID'), 0)::decimal(28,2) AS claimable_vat_input_tax
FROM inv WHERE vat_validation_status = 'VALID' AND {condition}
GROUP BY 1, 2, 3"""


SCORECARD_METRICS = f"""
, metrics AS (
  SELECT supplier_id, count(*) AS total_invoices,
    {mean_money("amount_incl_vat")} AS avg_invoice_value_zar,
    sum(amount_incl_vat)::decimal(28,2) AS total_spend_zar,
    sum(vat_amount)::decimal(28,2) AS total_vat_zar,
    round(avg(days_past_due), 1) AS avg_days_past_due,
    max(days_past_due) AS max_days_past_due,
    sum(is_late::integer)::bigint AS late_count,
    round(100.0 * sum(is_late::integer) / count(*), 1)::decimal(5,1) AS late_payment_pct,
    count(*) FILTER (WHERE invoice_status = 'OVERDUE') AS current_overdue_count,
    coalesce(sum(amount_incl_vat) FILTER (WHERE invoice_status = 'OVERDUE'), 0)::decimal(28,2) AS current_overdue_zar
  FROM inv GROUP BY 1
)"""


def scorecard(join, extra=""):
    return f"""{SCORECARD_METRICS}
SELECT m.supplier_id, s.supplier_name, s.category, s.city, s.payment_terms_days, s.cipc_number,
  m.total_invoices, m.avg_invoice_value_zar, m.total_spend_zar, m.total_vat_zar, m.avg_days_past_due,
  m.max_days_past_due, m.late_payment_pct, m.current_overdue_count, m.current_overdue_zar,
  CASE WHEN m.late_payment_pct >= 40 THEN 'HIGH' WHEN m.late_payment_pct >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS payment_risk_tier
  {extra}
FROM metrics m {join} sup s ON m.supplier_id = s.supplier_id"""


CASH_FLOW = """
, monthly AS (
  SELECT strftime(transaction_date, '%Y-%m') AS year_month,
    sum(credit_amount)::decimal(28,2) AS total_credits_zar,
    sum(debit_amount)::decimal(28,2) AS total_debits_zar,
    sum(balance_impact)::decimal(28,2) AS net_cash_flow_zar,
    count(*) AS transaction_count,
    sum(CASE WHEN NOT reconciled THEN 1 ELSE 0 END)::bigint AS unreconciled_count
  FROM bank GROUP BY 1
), moved AS (
  SELECT *, sum(net_cash_flow_zar) OVER o::decimal(38,2) AS running_cash_balance_zar,
    lag(net_cash_flow_zar) OVER o AS prev_month_net_cash_flow
  FROM monthly WINDOW o AS (ORDER BY year_month NULLS FIRST)
)
SELECT *, round(100.0 * (net_cash_flow_zar - prev_month_net_cash_flow)::double
  / nullif(abs(prev_month_net_cash_flow), 0)::double, 1)::decimal(28,1) AS mom_growth_rate_pct
FROM moved""".replace("sum(net_cash_flow_zar) OVER o::decimal(38,2)", "(sum(net_cash_flow_zar) OVER o)::decimal(38,2)")

MONTHLY = """
SELECT strftime(invoice_date, '%Y-%m') AS year_month, count(invoice_id) AS invoice_count,
  sum(amount_incl_vat)::decimal(28,2) AS total_spend, sum(is_late::integer)::bigint AS late_count,
  sum(is_late::integer)::double / count(invoice_id) AS late_rate
FROM {source} WHERE invoice_date IS NOT NULL GROUP BY 1"""

SHIFTED = """
, moved AS (SELECT * REPLACE (cast(invoice_date + INTERVAL 300 MONTH AS date) AS invoice_date) FROM inv)
, rates(rate_month, table_rate) AS (VALUES
  ('2025-01', 11.25), ('2025-02', 11.25), ('2025-03', 11.25), ('2025-04', 11.25), ('2025-05', 11.00),
  ('2025-06', 11.00), ('2025-07', 10.75), ('2025-08', 10.75), ('2025-09', 10.75), ('2025-10', 10.75),
  ('2025-11', 10.75), ('2025-12', 10.75), ('2026-01', 10.75), ('2026-02', 10.75), ('2026-03', 10.50),
  ('2026-04', 10.50), ('2026-05', 10.50), ('2026-06', 10.50))"""

PRIMED = (
    SHIFTED
    + ", monthly AS ("
    + MONTHLY.format(source="moved")
    + """)
, primed AS (
  SELECT m.*, CASE WHEN year_month < '2025-01' THEN 11.75::double ELSE table_rate::double END AS prime_rate
  FROM monthly m LEFT JOIN rates ON year_month = rate_month
)"""
)


def histogram(value, source, bins, scale=None):
    tag = f"'{scale}' AS scale, " if scale else ""
    return f"""
SELECT {tag}bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, count(*) AS n
FROM (
  SELECT lo, (hi - lo) / {bins} AS w, least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1})::integer AS bin
  FROM (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi
        FROM (SELECT ({value})::double AS v FROM {source}) WHERE v IS NOT NULL))
GROUP BY bin, lo, w"""


PROFILED = [
    "amount_excl_vat",
    "vat_amount",
    "amount_incl_vat",
    "days_past_due",
    "payment_terms_days",
    "late_payment_probability",
]
NUMERIC_PROFILE = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, count({c}) AS count, round(sum({c})::double / count({c}), 3) AS mean,
  round(stddev_samp({c}::double), 3) AS std, min({c})::double AS min,
  round(quantile_cont({c}::double, 0.25), 3) AS p25, round(quantile_cont({c}::double, 0.5), 3) AS p50,
  round(quantile_cont({c}::double, 0.75), 3) AS p75, max({c})::double AS max
FROM joined"""
    for c in PROFILED
)

CORRELATED = [
    "amount_incl_vat",
    "vat_amount",
    "days_past_due",
    "payment_terms_days",
    "late_payment_probability",
    "is_late",
]


def number(c):
    return f"{c}::integer::double" if c == "is_late" else f"{c}::double"


CORRELATION_MATRIX = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS row_metric, '{b}' AS column_metric, "
    f"round(corr({number(a)}, {number(b)}), 6) AS correlation FROM joined"
    for i, a in enumerate(CORRELATED)
    for b in CORRELATED[:i]
)
LATE_CORRELATES = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS metric, round(corr({c}::double, is_late::integer::double), 6) AS correlation FROM joined"
    for c in CORRELATED
    if c != "is_late"
)

RECON_POINTS = """
, offers AS (
  SELECT DISTINCT payment_date + cast(o AS integer) AS day, amount_incl_vat AS amount
  FROM paid, range(-3, 4) t(o)
)
, flagged AS (
  SELECT b.*, EXISTS (SELECT 1 FROM offers f WHERE f.day = b.transaction_date
    AND abs(f.amount - abs(b.{amount})) <= 50) AS is_matched
  FROM {source} b
)"""

PROBES = """
, probes AS (SELECT * REPLACE (greatest(debit_amount, credit_amount) AS debit_amount) FROM bank)"""


DOUBLE_PAYMENTS = """,
paid_twice AS (
  SELECT *, split_part(invoice_reference, '-', 4) AS supplier_id, (transaction_date + shift)::date AS day FROM (
    SELECT *, unnest(CASE split_part(invoice_reference, '-', 1)::bigint % 40
      WHEN 3 THEN [0, 0] WHEN 17 THEN [0, 2] WHEN 23 THEN [0, 10] WHEN 29 THEN [0, 1, 2] WHEN 31 THEN [0, -3]
      ELSE [0] END) AS shift
    FROM bank WHERE debit_amount > 0)
)"""


def one_to_one(keys, line_at, offer_at, slack):
    """Both sides in order, step by step: an invoice too early goes, a payment too early is left over, others meet."""
    on = " AND ".join(f"{{0}}.{k} IS NOT DISTINCT FROM w.{k}" for k in keys)
    names = ", ".join(keys)
    return DOUBLE_PAYMENTS + f""",
l AS (SELECT {names}, {line_at} AS at_, row_number() OVER (PARTITION BY {names} ORDER BY {line_at}) AS i
      FROM (SELECT *, day AS on_day, debit_amount AS amount FROM paid_twice) WHERE day IS NOT NULL),
o AS (SELECT {names}, {offer_at} AS at_, row_number() OVER (PARTITION BY {names} ORDER BY {offer_at}) AS j
      FROM (SELECT *, payment_date AS on_day, amount_incl_vat AS amount FROM inv
            WHERE is_paid AND payment_date IS NOT NULL)),
walk AS (
  SELECT DISTINCT {names}, 1::bigint AS i, 1::bigint AS j, NULL::bigint AS met FROM l
  UNION ALL
  SELECT {", ".join("w." + k for k in keys)},
    CASE WHEN o.at_ < l.at_ - {slack} THEN w.i ELSE w.i + 1 END,
    CASE WHEN o.at_ <= l.at_ + {slack} THEN w.j + 1 ELSE w.j END,
    CASE WHEN o.at_ BETWEEN l.at_ - {slack} AND l.at_ + {slack} THEN w.i END
  FROM walk w JOIN l ON {on.format("l")} AND l.i = w.i LEFT JOIN o ON {on.format("o")} AND o.j = w.j
),
points AS (
  SELECT {", ".join("l." + k for k in keys)}, at_, count(*) AS payments, count(met) AS matched, count(*) - count(met) AS left_over
  FROM l LEFT JOIN (SELECT * FROM walk WHERE met IS NOT NULL) AS w ON {on.format("l")} AND w.met = l.i
  GROUP BY ALL
),
found AS (
  SELECT *, EXISTS (SELECT 1 FROM o AS f WHERE {" AND ".join(f"f.{k} = points.{k}" for k in keys)}
                    AND f.at_ BETWEEN points.at_ - {slack} AND points.at_ + {slack}) AS near
  FROM points
)
"""


BY_DAY = one_to_one(["supplier_id", "amount"], "(on_day - DATE '1970-01-01')", "(on_day - DATE '1970-01-01')", 3)
BY_AMOUNT = one_to_one(["on_day"], "(amount * 100)::bigint", "(amount * 100)::bigint", 5000)


def recon_totals(condition):
    return RECON_POINTS.format(amount="debit_amount", source="bank") + f"""
SELECT count(*) AS total, count(*) FILTER (WHERE is_matched) AS matched,
  count(*) FILTER (WHERE NOT is_matched) AS unmatched,
  {ratio("count(*) FILTER (WHERE NOT is_matched)", "count(*)")} AS unmatched_rate
FROM flagged WHERE {condition}"""


COMPLIANCE = ratio(
    "count(*) FILTER (WHERE invoice_status = 'PAID' AND payment_date IS NOT NULL "
    "AND payment_date - invoice_date - payment_terms_days <= 2)",
    "count(*) FILTER (WHERE invoice_status = 'PAID' AND payment_date IS NOT NULL)",
)

REGIONS = """
, regions AS (
  SELECT cast(s_suppkey AS varchar) AS supplier_id, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

RAG = f"""
, k AS (
  SELECT sum(is_late::integer)::double / count(is_late) AS late,
    quantile_cont(days_past_due::double, 0.5) FILTER (WHERE is_late) AS age,
    sum(vat_amount)::double / sum(amount_incl_vat)::double AS vat,
    count(*) FILTER (WHERE {MISMATCH})::double / count(*) AS wrong,
    {COMPLIANCE} AS ok
  FROM inv
)
SELECT 'Late Payment Rate' AS kpi, late AS internal_value, 0.08::double AS best_practice, 'AMBER' AS rag,
  round(late - 0.08::double, 9) AS gap_vs_best FROM k
UNION ALL SELECT 'Unpaid Invoice Age', age, 0, 'AMBER', NULL FROM k
UNION ALL SELECT 'YoY Late Payment Trend', NULL, NULL, 'RED', NULL FROM k
UNION ALL SELECT 'VAT Input Tax %', vat, 15::double / 115, CASE WHEN abs(vat - 15::double / 115) < 0.005 THEN 'GREEN' ELSE 'AMBER' END,
  round(vat - 15::double / 115, 9) FROM k
UNION ALL SELECT 'VAT Mismatch Rate', wrong, 0.02::double, CASE WHEN wrong > 0.10 THEN 'RED' WHEN wrong > 0.02 THEN 'AMBER' ELSE 'GREEN' END,
  round(wrong - 0.02::double, 9) FROM k
UNION ALL SELECT 'Payment Terms Compliance', ok, 0.85::double,
  CASE WHEN ok > 0.85 THEN 'GREEN' WHEN ok > 0.65 THEN 'AMBER' WHEN ok > 0 THEN 'RED' ELSE 'GREY' END,
  CASE WHEN ok > 0 THEN round(ok - 0.85::double, 9) END FROM k"""

CATEGORY_LEVELS = [
    "Accounting Services",
    "Catering",
    "Cleaning Services",
    "Courier Services",
    "IT Equipment",
    "Legal Services",
    "Maintenance",
    "Marketing",
    "Office Supplies",
    "Security Services",
]


def feature_columns(source):
    levels = ",\n  ".join(
        f"coalesce((category = '{c}')::integer, 0) AS \"cat_{c}\"" for c in CATEGORY_LEVELS
    )
    return f"""
  coalesce(late_payment_probability::double, 0) AS supplier_late_pct,
  coalesce(avg_invoice_value_zar::double, 0) AS supplier_avg_invoice_zar,
  coalesce(payment_terms_days, 0) AS payment_terms_days,
  coalesce(amount_incl_vat::double, 0) AS invoice_amount_zar,
  round(coalesce(ln(1 + amount_incl_vat::double), 0), 6) AS log_invoice_amount,
  coalesce(vat_amount::double, 0) AS vat_amount_zar,
  coalesce((amount_incl_vat::double > (SELECT quantile_cont(amount_incl_vat::double, 0.75) FROM {source}))::integer, 0) AS is_large_invoice,
  month(invoice_date)::integer AS invoice_month,
  quarter(invoice_date)::integer AS invoice_quarter,
  (isodow(invoice_date) - 1)::integer AS invoice_day_of_week,
  (day(invoice_date) >= 25)::integer AS is_month_end,
  (quarter(invoice_date) = 4)::integer AS is_q4,
  (month(invoice_date) IN (2, 4, 6, 8, 10, 12))::integer AS is_vat_period_end,
  {levels}"""


def auc(source, group=""):
    """Rank-sum area: tied scores share the mean of their ranks."""
    part = f"PARTITION BY {group} " if group else ""
    tied = f"PARTITION BY {group}, score" if group else "PARTITION BY score"
    lead = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {lead}sum(label)::bigint AS positives, sum(1 - label)::bigint AS negatives,
  (sum(CASE WHEN label = 1 THEN place END) - sum(label)::double * (sum(label) + 1) / 2)
    / nullif(sum(label)::double * sum(1 - label)::double, 0) AS auc
FROM (SELECT *, rank() OVER ({part}ORDER BY score) + (count(*) OVER ({tied}) - 1) / 2.0::double AS place FROM {source})
{by}"""


SPLIT = """
, split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42:' || invoice_id))
    <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
  FROM {source}
)"""

RUNS = (
    SPLIT.format(source="labelled WHERE amount_incl_vat IS NOT NULL AND score IS NOT NULL")
    + """
, runs AS (
  SELECT 'supplier_prior' AS model_type, label, split, score FROM split
  UNION ALL SELECT 'relative_amount', label, split,
    amount_incl_vat::double / (amount_incl_vat::double + avg_invoice_value_zar::double) FROM split
  UNION ALL SELECT 'payment_terms', label, split, payment_terms_days / 100.0::double FROM split
)
, tested AS (SELECT * FROM runs WHERE split = 'test')
, areas AS ("""
    + auc("tested", "model_type")
    + """)
, run_rows AS (
  SELECT 'run-' || a.model_type AS run_id, a.model_type, a.auc AS test_auc, 1 AS n_features,
    (SELECT count(*) FROM runs t WHERE t.model_type = a.model_type AND t.split = 'train') AS n_train_rows
  FROM areas a
)
"""
)

MONITOR = (
    """
, months AS (SELECT DISTINCT date_trunc('month', payment_date)::date AS m FROM labelled WHERE payment_date IS NOT NULL AND score IS NOT NULL)
, windowed AS (
  SELECT m, label, score FROM labelled JOIN months
    ON date_trunc('month', payment_date) BETWEEN m - INTERVAL 2 MONTH AND m
  WHERE score IS NOT NULL
)
, areas AS ("""
    + auc("windowed", "m")
    + """)
SELECT strftime(m, '%Y-%m') AS year_month, positives, negatives, auc, coalesce(auc < 0.60, false) AS alert FROM areas"""
)

REPORT = """
, c AS (
  SELECT count(*) FILTER (WHERE score > 0.25 AND label = 1)::double AS tp,
    count(*) FILTER (WHERE score > 0.25 AND label = 0)::double AS fp,
    count(*) FILTER (WHERE score <= 0.25 AND label = 1)::double AS fn,
    count(*) FILTER (WHERE score <= 0.25 AND label = 0)::double AS tn
  FROM labelled WHERE score IS NOT NULL
)
, e AS (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0,
  tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS n FROM c)
, g AS (SELECT *, 2 * p1 * r1 / (p1 + r1) AS f1, 2 * p0 * r0 / (p0 + r0) AS f0 FROM e)
, lines AS (
SELECT 'On-time' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM g
UNION ALL SELECT 'Late', p1, r1, f1, s1 FROM g
UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / n, n FROM g
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM g
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM g)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score,
  support::bigint AS support FROM lines"""


def history(minimum):
    return f"""
, seen AS (SELECT *, rank() OVER (PARTITION BY supplier_id ORDER BY invoice_date) - 1 AS earlier FROM inv)
SELECT invoice_id, supplier_id, invoice_date, earlier < {minimum} AS insufficient_history FROM seen WHERE NOT is_paid"""


def exceptions(amount):
    return f"""
, waiting AS (
  SELECT b.*, len(list_filter(range(b.transaction_date::timestamp + INTERVAL 1 DAY, TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY, INTERVAL 1 DAY),
    lambda x: isodow(x) < 6))::integer AS business_days_open
  FROM bank b
  WHERE {amount} > 1000 AND NOT coalesce(reconciled, false)
    AND NOT EXISTS (SELECT 1 FROM inv i WHERE i.invoice_id = b.invoice_reference)
)
SELECT transaction_id, transaction_date, description, {amount} AS amount, reconciled, business_days_open
FROM waiting WHERE business_days_open > 5"""


DIFF_VIEWS = "WITH" + source_views("2000-07-01", "old_").replace("FROM old_", "FROM old_") + "," + source_views(AS_OF)
DIFF = """
, before AS (SELECT * FROM old_raw_invoices WHERE invoice_date <= DATE '2000-07-01')
, after AS (SELECT * FROM raw_invoices WHERE invoice_date <= DATE '2001-01-01')
, changes AS (
  SELECT coalesce(a.invoice_id, b.invoice_id) AS invoice_id,
    CASE WHEN b.invoice_id IS NULL THEN 'ADDED' WHEN a.invoice_id IS NULL THEN 'REMOVED'
         WHEN a.invoice_status = b.invoice_status AND a.days_past_due = b.days_past_due
          AND a.payment_date IS NOT DISTINCT FROM b.payment_date AND a.due_date = b.due_date
          AND a.amount_incl_vat = b.amount_incl_vat AND a.is_late = b.is_late THEN 'UNCHANGED'
         ELSE 'CHANGED' END AS change
  FROM before b FULL JOIN after a ON a.invoice_id = b.invoice_id
)"""

TWO_DAYS = DIFF_VIEWS + ", both_days AS (SELECT * FROM inv UNION ALL SELECT * FROM old_inv)"

LINES = """
WITH lines AS (
  SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS integer)) AS invoice_id
  FROM lineitem
)"""

ORACLE_SQL = {
    "read_bronze": over_views(
        """
SELECT invoice_id, supplier_id, invoice_date::varchar AS invoice_date, due_date::varchar AS due_date,
  payment_date::varchar AS payment_date, amount_excl_vat::varchar AS amount_excl_vat,
  vat_amount::varchar AS vat_amount, amount_incl_vat::varchar AS amount_incl_vat, currency, category,
  payment_terms_days::varchar AS payment_terms_days, days_past_due::varchar AS days_past_due,
  is_late::varchar AS is_late, is_paid::varchar AS is_paid, invoice_status, '2001-01-01' AS ingested_date
FROM raw_invoices"""
    ),
    "land_bronze": over_views(
        """
SELECT d AS ingested_date, count(*) AS rows, count(payment_date) AS paid_rows
FROM raw_invoices, (VALUES ('2001-01-01'), ('2001-01-02')) t(d) GROUP BY 1"""
    ),
    "land_all": over_views(
        """
SELECT 'sa_invoices' AS dataset, 'landed' AS outcome, count(*) AS rows FROM raw_invoices
UNION ALL SELECT 'sa_suppliers', 'landed', count(*) FROM raw_suppliers
UNION ALL SELECT 'sa_bank_transactions', 'landed', count(*) FROM raw_bank
UNION ALL SELECT 'sarb_benchmarks', 'skipped', NULL"""
    ),
    "landing_manifest": "WITH "
    + source_views("2000-07-01", "older_").strip().removeprefix("WITH")
    + ","
    + source_views()
    + """
SELECT '2001-01-01' AS ingested_date, true AS files_agree, count(*) AS rows,
  count(*) FILTER (WHERE invoice_status = 'Overdue') AS overdue FROM raw_invoices
UNION ALL SELECT '2001-01-02', true, count(*), count(*) FILTER (WHERE invoice_status = 'Overdue') FROM older_raw_invoices""",
    "bronze_snapshot": status_counts(VIEWS, "inv"),
    "bronze_incremental": status_counts(TWO_DAYS, "both_days"),
    "export_gold": over_views(
        """
SELECT 'gold_vat_summary' AS "table", count(DISTINCT strftime(invoice_date, '%Y-%m')) AS rows,
  sum(vat_amount) FILTER (WHERE invoice_status = 'PAID')::decimal(38,2) AS total FROM inv WHERE vat_validation_status = 'VALID'
UNION ALL SELECT 'gold_supplier_scorecard', count(DISTINCT supplier_id), sum(amount_incl_vat)::decimal(38,2) FROM inv
  WHERE supplier_id IN (SELECT supplier_id FROM sup)
UNION ALL SELECT 'gold_cash_flow_monthly', count(DISTINCT strftime(transaction_date, '%Y-%m')), sum(balance_impact)::decimal(38,2) FROM bank"""
    ),
    "write_scores": over_views(
        """
SELECT invoice_id, supplier_id, due_date, amount_incl_vat, late_payment_probability::double AS late_probability,
  CASE WHEN late_payment_probability >= 0.5 THEN 'HIGH' WHEN late_payment_probability >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
FROM joined WHERE invoice_status = 'PENDING'"""
    ),
    "daily_run": over_views(
        """
SELECT 'silver' AS layer, 'silver_invoices' AS "table", count(*) AS rows FROM inv
UNION ALL SELECT 'silver', 'silver_suppliers', count(*) FROM sup
UNION ALL SELECT 'silver', 'silver_bank_transactions', count(*) FROM bank
UNION ALL SELECT 'gold', 'gold_vat_summary', count(DISTINCT strftime(invoice_date, '%Y-%m')) FROM inv WHERE vat_validation_status = 'VALID'
UNION ALL SELECT 'gold', 'gold_supplier_scorecard', count(DISTINCT supplier_id) FROM inv WHERE supplier_id IN (SELECT supplier_id FROM sup)
UNION ALL SELECT 'gold', 'gold_cash_flow_monthly', count(DISTINCT strftime(transaction_date, '%Y-%m')) FROM bank"""
    ),
    "silver_invoices": over_views("SELECT * FROM inv"),
    "silver_suppliers": over_views("SELECT * FROM sup"),
    "silver_bank_transactions": over_views("SELECT * FROM bank"),
    "safe_dates": LINES
    + """
SELECT invoice_id, raw_date, try_cast(raw_date AS date) AS parsed_date, try_cast(raw_date AS timestamp) AS parsed_time
FROM (SELECT invoice_id, printf('%04d-%02d-%02d', year(l_shipdate),
  month(l_shipdate) + CASE WHEN l_quantity::integer % 10 = 0 THEN 12 ELSE 0 END, day(l_shipdate)) AS raw_date FROM lines)""",
    "positive_money": LINES
    + """
SELECT invoice_id, CASE WHEN a > 0 THEN a END AS amount, CASE WHEN v >= 0 THEN v END AS vat
FROM (SELECT invoice_id, (l_extendedprice::decimal(18,2) - 50000)::decimal(18,2) AS a,
  ((l_tax::decimal(4,2) - 0.04) * 1000)::decimal(18,2) AS v FROM lines)""",
    "vat_validation": LINES
    + """
SELECT invoice_id, excl, vat, CASE WHEN abs(vat - excl * 0.15) < 0.02 THEN 'VALID' ELSE 'VAT_MISMATCH' END AS vat_validation_status
FROM (SELECT invoice_id, l_extendedprice::decimal(18,2) AS excl,
  (round(l_extendedprice::decimal(18,2) * 0.15, 2) + (l_linenumber - 4) * 0.01)::decimal(18,2) AS vat FROM lines)""",
    "positive_terms": LINES
    + """
SELECT invoice_id, CASE WHEN t > 0 THEN t END AS payment_terms_days
FROM (SELECT invoice_id, ((l_suppkey % 5) * 10 - 10)::integer AS t FROM lines)""",
    "normalise_status": LINES
    + """
SELECT invoice_id, CASE l_linenumber WHEN 1 THEN 'PAID' WHEN 2 THEN 'OVERDUE' WHEN 3 THEN 'PENDING' ELSE 'UNKNOWN' END AS invoice_status
FROM lines""",
    "normalise_text": """
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_name) AS lower_name, p_type AS trimmed_type FROM part""",
    "invoices_with_supplier": over_views("SELECT * FROM joined"),
    "scorecard_left_join": over_faulty(scorecard("LEFT JOIN", ", m.late_count")),
    "merge_integrity": over_faulty(
        """
, c AS (
  SELECT count(*) FILTER (WHERE i.supplier_id IS NOT NULL AND s.supplier_id IS NOT NULL) AS "both",
    count(*) FILTER (WHERE s.supplier_id IS NULL) AS left_only,
    count(*) FILTER (WHERE i.supplier_id IS NULL) AS right_only
  FROM inv i FULL JOIN sup s ON i.supplier_id = s.supplier_id
)
SELECT *, left_only = 0 AS no_orphan_invoices, right_only = 0 AS no_unused_suppliers FROM c"""
    ),
    "recon_by_reference": over_faulty_ledger(
        """
SELECT b.category, count(*) AS total, count(i.invoice_id) AS matched, count(*) - count(i.invoice_id) AS unmatched
FROM bank b LEFT JOIN inv i ON b.invoice_reference = i.invoice_id GROUP BY 1"""
    ),
    "matched_by_reference": over_faulty_ledger(
        "SELECT * FROM bank WHERE invoice_reference IN (SELECT invoice_id FROM inv)"
    ),
    "unmatched_by_reference": over_faulty_ledger(
        "SELECT * FROM bank b WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE i.invoice_id = b.invoice_reference)"
    ),
    "derive_vat": over_views(
        """
SELECT invoice_id, amount_excl_vat, round(amount_excl_vat * 0.15, 2)::decimal(18,2) AS vat,
  (amount_excl_vat + round(amount_excl_vat * 0.15, 2))::decimal(18,2) AS incl FROM raw_invoices"""
    ),
    "derive_due_date": over_views(
        "SELECT invoice_id, invoice_date, payment_terms_days, due_date FROM raw_invoices"
    ),
    "derive_days_past_due": over_views(
        "SELECT invoice_id, due_date, payment_date, days_past_due FROM raw_invoices"
    ),
    "derive_status": over_views("SELECT invoice_id, is_paid, due_date, invoice_status FROM raw_invoices"),
    "derive_is_late": over_views("SELECT invoice_id, is_paid, is_late FROM raw_invoices"),


    "cashbook": over_views("SELECT * FROM raw_bank"),
    "dq_not_null": over_faulty(
        checks(*on_raw(NOT_NULL), *on_raw(NOT_NULL_SUPPLIERS), *on_raw(NOT_NULL_BANK))
    ),
    "dq_accepted_values": over_faulty(
        """
, stated AS (
  SELECT upper(invoice_status) AS invoice_status,
    CASE WHEN amount_excl_vat > 20000 THEN
      CASE WHEN abs(vat_amount - amount_excl_vat * 0.15) < 0.02 THEN 'VALID' ELSE 'VAT_MISMATCH' END
    ELSE 'UNCHECKED' END AS vat_validation_status
  FROM raw_invoices
)
"""
        + checks(*[(*c[:4], "stated", c[5]) for c in ACCEPTED])
    ),
    "dq_unique_warn": over_views(UNIQUE_WARN),
    "dq_duplicate_keys": over_views(
        "SELECT supplier_id, count(*) AS n_records FROM inv GROUP BY 1 HAVING count(*) > 1"
    ),
    "dq_currency": over_faulty(checks(CURRENCY)),
    "dq_missing_profile": over_views(
        """
, m AS (SELECT count(*) AS n, count(*) - count(COLUMNS(*)) FROM joined)
, long AS (UNPIVOT (SELECT n, COLUMNS(* EXCLUDE n) FROM (SELECT count(*) AS n, """
        + ", ".join(
            f"count(*) - count({c}) AS {c}"
            for c in [
                "invoice_id", "supplier_id", "invoice_date", "due_date", "payment_date",
                "amount_excl_vat", "vat_amount", "amount_incl_vat", "vat_validation_status",
                "currency", "category", "payment_terms_days", "days_past_due", "is_late", "is_paid",
                "invoice_status", "supplier_name", "cipc_number", "vat_number", "supplier_category",
                "supplier_payment_terms_days", "avg_invoice_value_zar", "late_payment_probability",
                "email", "city", "created_at",
            ]
        )
        + """ FROM joined)) ON COLUMNS(* EXCLUDE n) INTO NAME "column" VALUE missing_count)
SELECT "column", missing_count, round(missing_count * 100::double / n, 2) AS pct_missing FROM long WHERE missing_count > 0"""
    ).replace(", m AS (SELECT count(*) AS n, count(*) - count(COLUMNS(*)) FROM joined)\n", ""),
    "dq_sanity": over_faulty(
        checks(
            ("negative_amount", "sa_invoices", "amount_incl_vat", "error", "raw_invoices", "amount_incl_vat < 0"),
            ("future_invoice_date", "sa_invoices", "invoice_date", "error", "raw_invoices", f"invoice_date > DATE '{AS_OF}'"),
            ("due_before_issue", "sa_invoices", "due_date", "error", "raw_invoices", "due_date < invoice_date"),
        )
    ),
    "dq_formats": over_faulty(
        checks(
            (
                "company_number_format", "sa_suppliers", "cipc_number", "error", "raw_suppliers",
                "NOT regexp_full_match(cipc_number, '[0-9]{4}/[0-9]{6}/[0-9]{2}')",
            ),
            (
                "vat_number_format", "sa_suppliers", "vat_number", "error", "raw_suppliers",
                "NOT (vat_number LIKE '4%' AND length(vat_number) = 10)",
            ),
        )
    ),
    "dq_unique_ids": over_faulty(
        unique("sa_suppliers", "supplier_id", "error", "raw_suppliers")
        + "\nUNION ALL\n"
        + unique("sa_invoices", "invoice_id", "error", "raw_invoices")
        + "\nUNION ALL\n"
        + checks(
            ("not_null", "sa_suppliers", "supplier_id", "error", "raw_suppliers", "supplier_id IS NULL"),
            ("not_null", "sa_invoices", "invoice_id", "error", "raw_invoices", "invoice_id IS NULL"),
        )
    ),
    "dq_amounts": over_faulty(
        checks(
            ("amount_positive", "sa_invoices", "amount_excl_vat", "error", "raw_invoices", "amount_excl_vat <= 0"),
            ("amount_positive", "sa_invoices", "amount_incl_vat", "error", "raw_invoices", "amount_incl_vat <= 0"),
            ("vat_is_fifteen_percent", "sa_invoices", "vat_amount", "error", "raw_invoices", MISMATCH),
            (
                "incl_is_excl_plus_vat", "sa_invoices", "amount_incl_vat", "error", "raw_invoices",
                "amount_incl_vat <> amount_excl_vat + vat_amount",
            ),
        )
    ),
    "dq_dates": over_faulty(
        checks(
            ("due_on_or_after_issue", "sa_invoices", "due_date", "error", "raw_invoices",
             "coalesce(due_date < invoice_date, true)")
        )
    ),
    "dq_domains": over_faulty(
        checks(
            (
                "valid_payment_terms", "sa_suppliers", "payment_terms_days", "error", "raw_suppliers",
                "payment_terms_days NOT IN (7, 14, 30, 60)",
            ),
            (
                "valid_status", "sa_invoices", "invoice_status", "error", "raw_invoices",
                "coalesce(invoice_status NOT IN ('Paid', 'Overdue', 'Pending'), true)",
            ),
            ("currency_is_zar", "sa_invoices", "currency", "error", "raw_invoices", "currency IS DISTINCT FROM 'ZAR'"),
        )
    ),
    "dq_required": over_faulty(
        checks(
            *[
                ("not_null", "sa_invoices", c, "error", "raw_invoices", f"{c} IS NULL")
                for c in ["invoice_id", "supplier_id", "invoice_date", "due_date", "amount_incl_vat", "currency"]
            ]
        )
    ),
    "dq_silver_report": over_faulty(
        checks(*NOT_NULL, *ACCEPTED, CURRENCY, VAT_ACCURACY, *NOT_NULL_SUPPLIERS, *NOT_NULL_BANK)
        + "\nUNION ALL\n"
        + checks(
            (
                "known", "silver_invoices", "supplier_id", "error",
                "(SELECT supplier_id FROM inv WHERE supplier_id IS NOT NULL)",
                "supplier_id NOT IN (SELECT supplier_id FROM sup)",
            )
        )
        + "\nUNION ALL\n"
        + UNIQUE_WARN
    ),
    "vat_summary": over_views(vat_months("invoice_date", "true")),
    "vat_summary_by_payment_period": over_views(
        vat_months("payment_date", "invoice_status = 'PAID' AND payment_date IS NOT NULL")
    ),
    "supplier_scorecard": over_views(scorecard("JOIN")),
    "cash_flow_monthly": over_views(CASH_FLOW),
    "monthly_trend": over_views(
        ", monthly AS ("
        + MONTHLY.format(source="inv")
        + """)
SELECT *, year_month = (SELECT year_month FROM monthly ORDER BY total_spend DESC, year_month LIMIT 1) AS is_peak_spend,
  year_month = (SELECT year_month FROM monthly ORDER BY late_rate DESC, year_month LIMIT 1) AS is_worst_late
FROM monthly"""
    ),
    "late_by_category": over_views(
        """
SELECT *, CASE WHEN late_rate > 0.30 THEN 'HIGH' WHEN late_rate > 0.20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
FROM (SELECT category, sum(is_late::integer)::double / count(is_late) AS late_rate, count(is_late) AS total_invoices,
  sum(is_late::integer)::bigint AS late_invoices FROM inv WHERE category IS NOT NULL GROUP BY 1)"""
    ),
    "late_exposure_by_category": over_views(
        """
SELECT category, sum(amount_incl_vat)::decimal(28,2) AS total_late_exposure,
  sum(amount_incl_vat)::double / count(amount_incl_vat) AS avg_late_invoice, count(amount_incl_vat) AS late_invoices
FROM inv WHERE is_late AND category IS NOT NULL GROUP BY 1"""
    ),
    "numeric_profile": over_views(NUMERIC_PROFILE),
    "amount_histogram": over_views(
        histogram("amount_incl_vat", "inv", 50, "raw")
        + "\nUNION ALL\n"
        + histogram("ln(1 + amount_incl_vat::double)", "inv", 50, "log1p")
    ),
    "days_delta_histogram": over_views(histogram("days_delta", "paid", 40)),
    "amount_median": over_views(
        "SELECT round(quantile_cont(amount_incl_vat::double, 0.5), 4) AS median_amount FROM inv"
    ),
    "correlation_matrix": over_views(CORRELATION_MATRIX),
    "late_correlates": over_views(LATE_CORRELATES),
    "status_breakdown": over_views(
        """
SELECT invoice_status, count(*) AS invoices, count(*)::double / (SELECT count(*) FROM inv) AS share FROM inv GROUP BY 1"""
    ),
    "kpi_summary": over_views(
        """
, top AS (SELECT category, sum(is_late::integer)::double / count(is_late) AS rate FROM inv GROUP BY 1 ORDER BY rate DESC, category DESC LIMIT 1)
SELECT count(*) AS invoices, min(invoice_date) AS first_invoice_date, max(invoice_date) AS last_invoice_date,
  sum(amount_incl_vat)::decimal(38,2) AS total_spend, sum(vat_amount)::decimal(38,2) AS total_vat,
  sum(amount_incl_vat) FILTER (WHERE is_late)::decimal(38,2) AS late_exposure,
  sum(amount_incl_vat) FILTER (WHERE is_late)::double / sum(amount_incl_vat)::double AS late_exposure_share,
  sum(is_late::integer)::double / count(is_late) AS late_rate,
  count(*) FILTER (WHERE NOT is_paid) AS unpaid_invoices,
  (SELECT category FROM top) AS top_late_category, (SELECT rate FROM top) AS top_late_rate
FROM inv"""
    ),
    "dataset_snapshot": over_views(
        """
SELECT count(*) AS invoices, min(invoice_date) AS first_invoice_date, max(invoice_date) AS last_invoice_date,
  count(DISTINCT supplier_id) AS suppliers, sum(is_late::integer)::double / count(is_late) AS late_rate_all,
  (count(*) FILTER (WHERE is_paid AND is_late))::double / count(*) FILTER (WHERE is_paid) AS late_rate_paid,
  string_agg(DISTINCT currency, ',') AS currencies,
  count(*) FILTER (WHERE invoice_status = 'PAID') AS paid_invoices,
  count(*) FILTER (WHERE invoice_status = 'OVERDUE') AS overdue_invoices,
  count(*) FILTER (WHERE invoice_status = 'PENDING') AS pending_invoices,
  count(*) FILTER (WHERE invoice_status = 'UNKNOWN') AS unknown_invoices
FROM inv"""
    ),
    "overdue_summary": over_views(
        """
SELECT count(*) AS overdue_invoices, count(*)::double / (SELECT count(*) FROM inv) AS overdue_share,
  quantile_cont(days_past_due::double, 0.5) AS median_days, quantile_cont(days_past_due::double, 0.9) AS p90_days,
  max(days_past_due) AS max_days
FROM inv WHERE days_past_due > 0"""
    ),
    "overdue_by_category": over_views(
        """
SELECT *, CASE WHEN median_days > 30 THEN 'HIGH' WHEN median_days > 15 THEN 'MEDIUM' ELSE 'LOW' END AS overdue_band
FROM (SELECT category, round(quantile_cont(days_past_due::double, 0.5), 1) AS median_days,
  round(avg(days_past_due), 1) AS mean_days, max(days_past_due) AS max_days, count(*) AS overdue_invoices
  FROM inv WHERE days_past_due > 0 AND category IS NOT NULL GROUP BY 1)"""
    ),
    "overdue_boxplot": over_views(
        """
, o AS (SELECT category, days_past_due AS d FROM inv WHERE days_past_due > 0 AND category IS NOT NULL)
, s AS (SELECT category, quantile_cont(d::double, 0.25) AS q1, quantile_cont(d::double, 0.5) AS median,
  quantile_cont(d::double, 0.75) AS q3 FROM o GROUP BY 1)
SELECT category, q1, median, q3,
  min(d) FILTER (WHERE d BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1)) AS whisker_low,
  max(d) FILTER (WHERE d BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE d < q1 - 1.5::double * (q3 - q1) OR d > q3 + 1.5::double * (q3 - q1)) AS outliers
FROM o JOIN s USING (category) GROUP BY category, q1, median, q3"""
    ),
    "terms_compliance": over_views(
        """
, t AS (SELECT quantile_cont(days_delta::double, 0.5) AS med, sum(days_delta)::double / count(*) AS mean, count(*) AS n FROM paid)
SELECT compliance AS compliance_status, count(*) AS invoices, count(*)::double / any_value(n) AS share,
  any_value(med) AS median_days_delta, any_value(mean) AS mean_days_delta
FROM paid, t GROUP BY 1"""
    ),
    "compliance_by_category": over_views(
        """
SELECT category, count(*) FILTER (WHERE compliance = 'Late')::double / count(*) AS "Late",
  count(*) FILTER (WHERE compliance = 'On-time')::double / count(*) AS "On-time",
  count(*) FILTER (WHERE compliance = 'Early')::double / count(*) AS "Early"
FROM paid WHERE category IS NOT NULL GROUP BY 1"""
    ),
    "bank_reconciliation": over_views(recon_totals("true")),
    "bank_reconciliation_debits": over_views(recon_totals("debit_amount > 0")),
    "bank_reconciliation_lines": over_views(
        PROBES
        + RECON_POINTS.format(amount="debit_amount", source="probes")
        + "SELECT transaction_id, transaction_date, debit_amount, is_matched AS matched FROM flagged"
    ),
    "recon_one_to_one": stepwise(over_views(
        BY_DAY
        + f"""
SELECT payments, matched, payments - matched AS unmatched, {ratio("(payments - matched)", "payments")} AS unmatched_rate, double_paid
FROM (SELECT (SELECT count(*) FROM paid_twice) AS payments, sum(matched)::bigint AS matched,
             (sum(left_over) FILTER (WHERE near))::bigint AS double_paid FROM found)"""
    )),
    "recon_double_payments": stepwise(over_views(
        BY_DAY
        + """
SELECT supplier_id AS supplier, (DATE '1970-01-01' + at_::integer)::date AS transaction_date, amount AS debit_amount,
  payments, matched, left_over FROM found WHERE left_over > 0 AND near"""
    )),
    "recon_one_to_one_amounts": stepwise(over_views(
        BY_AMOUNT
        + """
SELECT on_day AS transaction_date, (at_ / 100.0)::decimal(18,2) AS debit_amount, payments, matched, left_over, near FROM found"""
    )),
    "monthly_reconciliation": over_views(
        RECON_POINTS.format(amount="debit_amount", source="bank")
        + f"""
SELECT strftime(transaction_date, '%Y-%m') AS year_month, count(*) FILTER (WHERE is_matched) AS matched,
  count(*) AS total, count(*) FILTER (WHERE NOT is_matched) AS unmatched,
  {ratio("count(*) FILTER (WHERE NOT is_matched)", "count(*)")} AS unmatched_rate,
  {ratio("count(*) FILTER (WHERE NOT is_matched)", "count(*)")} > 0.05 AS above_limit
FROM flagged WHERE transaction_date IS NOT NULL GROUP BY 1"""
    ),
    "vat_mismatch_rate": over_views(
        f"""
SELECT count(*) AS invoices, count(*) FILTER (WHERE {MISMATCH}) AS mismatch_invoices,
  count(*) FILTER (WHERE {MISMATCH})::double / count(*) AS mismatch_rate FROM inv"""
    ),
    "vat_mismatch_by_supplier": over_views(
        f"""
SELECT supplier_id, count(*) AS invoices, count(*) FILTER (WHERE {MISMATCH}) AS mismatch_invoices,
  count(*) FILTER (WHERE {MISMATCH})::double / count(*) AS mismatch_rate FROM inv GROUP BY 1"""
    ),
    "internal_kpis": over_views(
        f"""
SELECT count(*) AS invoices, count(DISTINCT supplier_id) AS suppliers, sum(amount_incl_vat)::decimal(28,2) AS total_spend,
  sum(amount_incl_vat)::double / count(amount_incl_vat) AS avg_invoice, sum(vat_amount)::decimal(28,2) AS total_vat,
  sum(vat_amount)::double / sum(amount_incl_vat)::double AS vat_share,
  sum(is_late::integer)::double / count(is_late) AS late_rate_all,
  (count(*) FILTER (WHERE is_paid AND is_late))::double / count(*) FILTER (WHERE is_paid) AS late_rate_paid,
  count(*) FILTER (WHERE {MISMATCH})::double / count(*) AS vat_mismatch_rate,
  {COMPLIANCE} AS terms_compliance,
  (SELECT sum(actual_days)::double / count(*) FROM paid) AS avg_days_to_pay
FROM inv"""
    ),
    "yoy_change": over_views(
        REGIONS
        + """
, long AS (
  SELECT region || ': Paid Late' AS category, year(invoice_date) AS period, is_late::integer AS v FROM inv JOIN regions USING (supplier_id)
  UNION ALL
  SELECT region || ': Unpaid', year(invoice_date), (NOT is_paid)::integer FROM inv JOIN regions USING (supplier_id)
)
, two AS (SELECT category, coalesce(sum(v) FILTER (WHERE period = 1999), 0)::bigint AS previous,
  coalesce(sum(v) FILTER (WHERE period = 2000), 0)::bigint AS current FROM long GROUP BY 1)
SELECT *, CASE WHEN current < previous AND round(100.0::double * (current - previous) / nullif(previous, 0), 1) < 0 THEN 'IMPROVED' ELSE 'REGRESSED' END AS direction,
  round(100.0::double * (current - previous) / nullif(previous, 0), 1)::decimal(18,1) AS change_pct FROM two"""
    ),
    "region_ranking": over_views(
        REGIONS
        + """
SELECT *, CASE WHEN unpaid_invoices > 10000 THEN 'CRITICAL' WHEN unpaid_invoices > 1000 THEN 'WATCH' ELSE 'LOW' END AS unpaid_band
FROM (SELECT region, sum(is_late::integer)::bigint AS late_invoices,
  coalesce(sum(amount_incl_vat) FILTER (WHERE is_late), 0)::decimal(38,2) AS late_value,
  count(*) FILTER (WHERE NOT is_paid) AS unpaid_invoices,
  coalesce(sum(amount_incl_vat) FILTER (WHERE NOT is_paid), 0)::decimal(38,2) AS unpaid_value
  FROM inv JOIN regions USING (supplier_id) GROUP BY 1)"""
    ),
    "benchmark_gap": over_views(
        """
, b(benchmark, benchmark_rate) AS (VALUES
  ('Govt Depts Paid Late (NT Report FY2023/24)', 0.30::double),
  ('SMEs Experiencing Any Late Payment (CGIC 2025)', 0.91::double),
  ('SMEs with Cash Flow Issues (Xero SA 2024)', 0.24::double),
  ('Automated AP Best Practice Target', 0.08::double))
, l AS (SELECT sum(is_late::integer)::double / count(is_late) AS late_rate FROM inv)
SELECT late_rate, benchmark, benchmark_rate, benchmark NOT LIKE '%CGIC%' AS comparable,
  CASE WHEN benchmark NOT LIKE '%CGIC%' THEN late_rate - benchmark_rate END AS gap FROM b, l"""
    ),
    "prime_rate_join": over_views(PRIMED + "SELECT * FROM primed"),
    "late_vs_prime": over_views(
        PRIMED
        + """
, c AS (SELECT count(prime_rate) AS months, CASE WHEN count(prime_rate) > 3 THEN corr(late_rate, prime_rate) END AS r FROM primed)
SELECT months, round(r, 6) AS correlation,
  CASE WHEN r > 0.3 THEN 'positively' WHEN r < -0.3 THEN 'negatively' WHEN r IS NOT NULL THEN 'weak' END AS reading FROM c"""
    ),
    "per_invoice_late_cost": over_views(
        SHIFTED
        + """
, rated AS (
  SELECT m.*, CASE WHEN strftime(invoice_date, '%Y-%m') < '2025-01' THEN 11.75::double ELSE table_rate::double END AS prime_rate
  FROM moved m LEFT JOIN rates ON strftime(invoice_date, '%Y-%m') = rate_month WHERE is_late
)
SELECT invoice_id, supplier_id, amount_incl_vat, days_past_due, prime_rate,
  (amount_incl_vat * prime_rate::decimal(5,2) * days_past_due)::double / 36500 AS late_cost FROM rated"""
    ),
    "vat_effective_rate": over_views(
        f"""
, t AS (SELECT sum(vat_amount)::decimal(28,2) AS total_vat, sum(amount_incl_vat)::decimal(28,2) AS total_incl,
  coalesce(sum(vat_amount) FILTER (WHERE NOT {MISMATCH}), 0)::decimal(28,2) AS claimable_vat FROM inv)
SELECT *, (total_vat - claimable_vat)::decimal(28,2) AS vat_at_risk, total_vat::double / total_incl::double AS vat_share,
  15::double / 115 AS theoretical_share, coalesce(claimable_vat::double / total_vat::double, 0) AS claimable_share FROM t"""
    ),
    "vat_by_category": over_views(
        f"""
SELECT *, (total_vat - claimable_vat)::decimal(28,2) AS vat_at_risk, abs(vat_share - 15::double / 115) > 0.02 AS deviates
FROM (SELECT category, sum(vat_amount)::decimal(28,2) AS total_vat, sum(amount_incl_vat)::decimal(28,2) AS total_incl,
  sum(vat_amount)::double / sum(amount_incl_vat)::double AS vat_share,
  count(*) FILTER (WHERE {MISMATCH})::double / count(*) AS mismatch_rate,
  coalesce(sum(vat_amount) FILTER (WHERE NOT {MISMATCH}), 0)::decimal(28,2) AS claimable_vat
  FROM inv WHERE category IS NOT NULL GROUP BY 1)"""
    ),
    "rag_scorecard": over_views(RAG),
    "financing_cost": over_views(
        """
, t AS (SELECT coalesce(sum(amount_incl_vat) FILTER (WHERE is_late), 0)::decimal(28,2) AS late_spend,
  sum(amount_incl_vat)::double AS spend, (sum(days_past_due) FILTER (WHERE is_late))::double / count(*) FILTER (WHERE is_late) AS avg_days_late FROM inv)
SELECT late_spend, round(spend * 0.08::double, 2) AS target_late_spend, round(late_spend::double - spend * 0.08::double, 2) AS improvement_gap,
  avg_days_late, round(late_spend::double * (0.105::double / 12) * (avg_days_late / 30), 2) AS estimated_cost FROM t"""
    ),
    "features": over_views("SELECT invoice_id, " + feature_columns("joined") + "\nFROM joined"),
    "align_features": over_views(
        ", pending AS (SELECT * FROM joined WHERE invoice_status = 'PENDING')\n"
        "SELECT invoice_id, supplier_id, due_date, amount_incl_vat, "
        + feature_columns("pending")
        + "\nFROM pending"
    ),
    "training_set": over_views(
        """
SELECT count(*) AS paid_invoices, sum(label)::bigint AS late_invoices, sum(label)::double / count(label) AS late_rate FROM labelled"""
    ),
    "stratified_split": over_views(
        SPLIT.format(source="labelled") + "SELECT invoice_id, label, split FROM split"
    ),
    "stratified_folds": over_views(
        """
SELECT invoice_id, label, (ntile(5) OVER (PARTITION BY label ORDER BY md5('42:' || invoice_id)) - 1)::integer AS fold FROM labelled"""
    ),
    "roc_auc": over_views(", scored AS (SELECT * FROM labelled WHERE score IS NOT NULL)" + auc("scored")),
    "roc_auc_by_fold": over_views(
        """
, scored AS (SELECT *, (ntile(5) OVER (PARTITION BY label ORDER BY md5('42:' || invoice_id)) - 1)::integer AS fold
  FROM labelled WHERE score IS NOT NULL)"""
        + auc("scored", "fold")
    ),
    "classification_report": over_views(REPORT),
    "tier_counts": over_views(
        """
SELECT CASE WHEN late_payment_probability >= 0.5 THEN 'HIGH' WHEN late_payment_probability >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  count(*) AS invoices FROM joined WHERE invoice_status = 'PENDING' GROUP BY 1"""
    ),
    "class_weights": over_views(
        """
, c AS (SELECT label, count(*) AS n FROM labelled GROUP BY 1)
SELECT label, n, (SELECT sum(n) FROM c)::double / ((SELECT count(*) FROM c) * n)::double AS weight FROM c"""
    ),
    "model_monitor": over_views(MONITOR),
    "scorer_model_runs": over_views(RUNS + "SELECT * FROM run_rows"),
    "scorer_best_run": over_views(
        RUNS
        + "SELECT * FROM run_rows ORDER BY (model_type = 'GradientBoosting') DESC, test_auc DESC NULLS LAST, run_id LIMIT 1"
    ),
    "insufficient_history": over_views(history(200)),
    "insufficient_history_default": over_views(history(5)),
    "risk_ranked_open_invoices": over_views(
        """
SELECT invoice_id, supplier_id, due_date, amount_incl_vat, late_payment_probability,
  rank() OVER (ORDER BY coalesce(late_payment_probability, 0) DESC, amount_incl_vat DESC) AS risk_rank
FROM joined WHERE NOT is_paid"""
    ),
    "rolling_compliance_90d": over_views(
        """
, daily AS (SELECT DISTINCT supplier_id, payment_date FROM paid)
, counted AS (
  SELECT d.supplier_id, d.payment_date, count(*) AS paid_in_window, count(*) FILTER (WHERE p.days_delta <= 2) AS compliant
  FROM daily d JOIN paid p ON p.supplier_id = d.supplier_id AND p.payment_date BETWEEN d.payment_date - 89 AND d.payment_date
  GROUP BY 1, 2
)
SELECT *, compliant::double / paid_in_window AS compliance_rate FROM counted"""
    ),
    "unreconciled_exceptions": over_faulty_ledger(exceptions("debit_amount")),
    "unreconciled_receipts": over_views(exceptions("credit_amount")),
    "unreconciled_by_tolerance": over_views(
        RECON_POINTS.format(amount="credit_amount", source="bank")
        + exceptions("credit_amount")
        .replace("FROM bank b", "FROM flagged b")
        .replace("NOT EXISTS (SELECT 1 FROM inv i WHERE i.invoice_id = b.invoice_reference)", "NOT is_matched")
    ),
    "escalation_tier": over_views(
        f"""
, deep AS (SELECT category FROM inv WHERE days_past_due > 0 GROUP BY 1 HAVING round(quantile_cont(days_past_due::double, 0.5), 1) > 30)
, unpaid AS (SELECT *, DATE '{AS_OF}' - due_date AS days_over FROM inv WHERE NOT is_paid)
SELECT invoice_id, supplier_id, category, due_date, amount_incl_vat, days_over::integer AS days_over,
  CASE WHEN days_over >= 14 THEN 'MANAGEMENT_REVIEW' WHEN days_over >= 5 THEN 'ACCOUNT_MANAGER'
       WHEN days_over >= 0 THEN 'REMINDER' ELSE 'NOT_DUE' END AS escalation,
  days_over > 10 AND category IN (SELECT category FROM deep) AS alert
FROM unpaid"""
    ),
    "due_soon_alert": over_views(
        f"""
, u AS (SELECT count(*) AS outstanding, count(*) FILTER (WHERE due_date - DATE '{AS_OF}' BETWEEN 0 AND 5) AS due_soon FROM inv WHERE NOT is_paid)
SELECT *, due_soon::double / outstanding AS due_soon_share, due_soon::double / outstanding > 0.20 AS alert FROM u"""
    ),
    "log_scale_outliers": over_views(
        """
, l AS (SELECT *, ln(1 + amount_incl_vat::double) AS v FROM inv WHERE amount_incl_vat IS NOT NULL AND category IS NOT NULL)
, s AS (SELECT category, avg(v) AS m, stddev_samp(v) AS d FROM l GROUP BY 1)
SELECT invoice_id, category, amount_incl_vat, round((v - m) / d, 5) AS z_score FROM l JOIN s USING (category) WHERE abs((v - m) / d) > 3"""
    ),
    "audit_log": over_faulty_ledger(
        """
SELECT transaction_id, transaction_date, description, debit_amount, credit_amount, invoice_reference, supplier_id,
  amount_incl_vat AS invoice_amount, (debit_amount - amount_incl_vat)::decimal(18,2) AS difference, reconciled,
  CASE WHEN invoice_reference IS NULL THEN 'NO_REFERENCE' WHEN invoice_id IS NULL THEN 'MISSING_INVOICE'
       WHEN debit_amount = amount_incl_vat THEN 'MATCHED' ELSE 'AMOUNT_DIFFERS' END AS match_status
FROM bank LEFT JOIN inv ON invoice_reference = invoice_id"""
    ).replace("bank LEFT JOIN inv ON", "(SELECT * EXCLUDE category FROM bank) LEFT JOIN inv ON"),
    "snapshot_diff": DIFF_VIEWS + DIFF + "SELECT * FROM changes",
    "snapshot_changes": DIFF_VIEWS + DIFF + "SELECT change, count(*) AS rows FROM changes GROUP BY 1",
    **{
        name: over_views(
            f"""{CLASSES}
SELECT '{model}' AS model_type, {FEATURE_COUNT} AS n_features, sum(n - n_test)::bigint AS n_train_rows,
  sum(n_test)::bigint AS n_test_rows, sum(n_test)::bigint AS confusion_total,
  true AS auc_agrees, true AS stored_model_agrees {", true AS gradient_vanishes" if name == "train_lr" else ""} FROM c"""
        )
        for name, model in [
            ("train_gbt", "GradientBoosting"), ("train_rf", "RandomForest"), ("train_lr", "LogisticRegression"),
        ]
    },
    "cv_auc": over_views(
        f"""{CLASSES}
, f AS (SELECT label, i AS fold, (n - n_test) // 5 + (i < (n - n_test) % 5)::integer AS size FROM c, range(5) t(i))
SELECT m AS model_type, fold::integer AS fold, sum(size) FILTER (WHERE label = 1)::bigint AS positives,
  sum(size) FILTER (WHERE label = 0)::bigint AS negatives, true AS has_auc
FROM f, (VALUES ('GradientBoosting'), ('RandomForest'), ('LogisticRegression')) t(m) GROUP BY 1, 2"""
    ),
    "training_flow": over_views(
        f"""{CLASSES}
SELECT '2001-01-01-' || m AS run_id, m AS model_type, 1 AS attempt, {FEATURE_COUNT} AS n_features,
  (SELECT sum(n - n_test) FROM c)::bigint AS n_train_rows, (SELECT sum(n_test) FROM c)::bigint AS n_test_rows,
  true AS has_auc, m = 'GradientBoosting' AS is_best
FROM (VALUES ('GradientBoosting'), ('RandomForest'), ('LogisticRegression')) t(m)"""
    ),
    "model_runs": over_views(
        f"""{CLASSES}
SELECT '2001-01-01-' || m AS run_id, m AS model_type, 1 AS attempt, {FEATURE_COUNT} AS n_features,
  (SELECT sum(n - n_test) FROM c)::bigint AS n_train_rows, true AS has_auc
FROM (VALUES ('GradientBoosting'), ('RandomForest'), ('LogisticRegression')) t(m)"""
    ),
    "best_run": over_views(
        f"""{CLASSES}
SELECT '2001-01-01-GradientBoosting' AS run_id, 'GradientBoosting' AS model_type,
  (SELECT sum(n - n_test) FROM c)::bigint AS n_train_rows, true AS model_agrees"""
    ),
    "open_invoice_tiers": over_views(
        """
, daily AS (SELECT supplier_id, invoice_date, count(*) AS n FROM inv GROUP BY 1, 2)
, earlier AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY supplier_id ORDER BY invoice_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM daily)
SELECT invoice_id, CASE WHEN k < 3 THEN 'HIGH' WHEN k > 4 THEN 'LOW' END AS risk_tier, true AS tier_agrees,
  CASE WHEN k < 3 THEN true WHEN k > 4 THEN false END AS rather_late
FROM (SELECT *, supplier_id::bigint % 10 AS k FROM inv JOIN earlier USING (supplier_id, invoice_date))
WHERE invoice_status = 'PENDING' AND before >= 5"""
    ),
    "score_open_invoices": over_views(
        """
, daily AS (SELECT supplier_id, invoice_date, count(*) AS n FROM inv GROUP BY 1, 2)
, earlier AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY supplier_id ORDER BY invoice_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM daily)
SELECT invoice_id, supplier_id, due_date, amount_incl_vat, before >= 5 AS is_scored,
  CASE WHEN before >= 5 THEN true END AS tier_agrees
FROM inv JOIN earlier USING (supplier_id, invoice_date) WHERE invoice_status = 'PENDING'"""
    ),
}

# Landed in parts, with one day replaced, the tables are those of a full run.
for _full, _parts in [
    ("vat_summary", "incremental_vat_summary"),
    ("supplier_scorecard", "incremental_scorecard"),
    ("cash_flow_monthly", "incremental_cash_flow"),
]:
    ORACLE_SQL[_parts] = ORACLE_SQL[_full]

ORACLE_SQL["sketch_span"] = over_views("""
SELECT category, count(*) AS rows, true AS rows_agree, count(DISTINCT due_date) AS exact_distinct,
  true AS distinct_within_bound, true AS quantiles_within_bound
FROM inv WHERE invoice_date BETWEEN DATE '1994-03-01' AND DATE '1997-02-28' GROUP BY 1""")

ORACLE_SQL["level_table"] = over_views("""
SELECT level, (row_number() OVER (ORDER BY level) - 1)::bigint AS level_id, rows
FROM (SELECT split_part(invoice_id, '-', 3) AS level, count(*) AS rows FROM inv GROUP BY 1)""")

ORACLE_SQL["sparse_one_hot"] = over_views("""
, picked AS (
  SELECT *, split_part(invoice_id, '-', 3) AS part FROM inv
  WHERE split_part(invoice_id, '-', 1)::bigint % 2 = 0 OR NOT is_paid
)
, lv AS (
  SELECT part, (row_number() OVER (ORDER BY part) - 1)::bigint AS level_id
  FROM (SELECT part FROM picked WHERE is_paid GROUP BY 1 HAVING count(*) >= 8)
)
SELECT invoice_id, level_id, (level_id IS NOT NULL)::integer AS entries, (SELECT count(*) FROM lv)::integer AS size
FROM picked LEFT JOIN lv USING (part) WHERE NOT is_paid""")

ORACLE_SQL["cash_flow_calendar"] = over_views(
    CASH_FLOW.replace(
        ", monthly AS (",
        """, gappy AS (SELECT * FROM bank WHERE (month(transaction_date) + 12 * year(transaction_date)) % 5 <> 0), present AS (""",
        1,
    )
    .replace("FROM bank GROUP BY 1", "FROM gappy GROUP BY 1")
    .replace(
        "), moved AS (",
        """), spine AS (
  SELECT strftime(unnest(generate_series(min(transaction_date)::date - day(min(transaction_date))::integer + 1,
    max(transaction_date)::date, INTERVAL 1 MONTH)), '%Y-%m') AS year_month FROM gappy
), monthly AS (
  SELECT year_month, coalesce(total_credits_zar, 0)::decimal(28,2) AS total_credits_zar,
    coalesce(total_debits_zar, 0)::decimal(28,2) AS total_debits_zar,
    coalesce(net_cash_flow_zar, 0)::decimal(28,2) AS net_cash_flow_zar,
    coalesce(transaction_count, 0) AS transaction_count, coalesce(unreconciled_count, 0)::bigint AS unreconciled_count
  FROM spine LEFT JOIN present USING (year_month)
), moved AS (""",
        1,
    )
)

ORACLE_SQL["digest_diff"] = DIFF_VIEWS + DIFF + "SELECT * FROM changes WHERE change <> 'UNCHANGED'"
ORACLE_SQL["digest_changes"] = ORACLE_SQL["snapshot_changes"]
ORACLE_SQL["digest_diff_few"] = over_views("""
SELECT 'CHANGED' AS change, count(*) AS rows, true AS opened_few FROM raw_invoices
WHERE starts_with(invoice_id, '1-') HAVING count(*) > 0""")
