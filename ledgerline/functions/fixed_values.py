"""They must equal the published rules and tables for right results."""

from decimal import Decimal

# Tax rule
VAT_RATE = Decimal("0.15")
VAT_TOLERANCE = Decimal("0.02")
VAT_SHARE_OF_INCL = 15 / 115
CURRENCY = "ZAR"

# Accepted sets
INVOICE_STATUSES = ["PAID", "OVERDUE", "PENDING", "UNKNOWN"]
RAW_INVOICE_STATUSES = ["Paid", "Overdue", "Pending"]
VAT_STATUSES = ["VALID", "VAT_MISMATCH"]
PAYMENT_TERMS = [7, 14, 30, 60]
SUPPLIER_CATEGORIES = [
    "Office Supplies",
    "IT Equipment",
    "Cleaning Services",
    "Courier Services",
    "Legal Services",
    "Accounting Services",
    "Marketing",
    "Security Services",
    "Maintenance",
    "Catering",
]
COMPANY_NUMBER_PATTERN = r"^\d{4}/\d{6}/\d{2}$"
VAT_NUMBER_PREFIX = "4"
VAT_NUMBER_LENGTH = 10

# Supplier prior = base + average / scale * weight
PRIOR_BASE = Decimal("0.10")
PRIOR_WEIGHT = Decimal("0.30")
PRIOR_SCALE = 150000

# thresholds
SCORECARD_HIGH_PCT = 40
SCORECARD_MEDIUM_PCT = 20
RISK_HIGH = 0.5
RISK_MEDIUM = 0.3
LATE_RATE_HIGH = 0.30
LATE_RATE_MEDIUM = 0.20
OVERDUE_DAYS_HIGH = 30
OVERDUE_DAYS_MEDIUM = 15
EARLY_BELOW_DAYS = -2
ON_TIME_UP_TO_DAYS = 2
RECON_DAYS = 3
RECON_AMOUNT = Decimal("50")
RECON_MONTHLY_LIMIT = 0.05
REGION_CRITICAL = 10000
REGION_WATCH = 1000
VAT_SHARE_DEVIATION = 0.02
CORRELATION_NOTABLE = 0.3
EXCEPTION_MIN_AMOUNT = Decimal("1000")
EXCEPTION_BUSINESS_DAYS = 5
ESCALATE_ACCOUNT_MANAGER_DAYS = 5
ESCALATE_MANAGEMENT_DAYS = 14
ESCALATE_ALERT_DAYS = 10
DUE_SOON_DAYS = 5
DUE_SOON_SHARE = 0.20
MIN_PRIOR_INVOICES = 5
MONITOR_MIN_AUC = 0.60
MONITOR_MONTHS = 3

# External late-rate benchmarks
BENCHMARK_RATES = {
    "Govt Depts Paid Late (NT Report FY2023/24)": 0.30,
    "SMEs Experiencing Any Late Payment (CGIC 2025)": 0.91,
    "SMEs with Cash Flow Issues (Xero SA 2024)": 0.24,
    "Automated AP Best Practice Target": 0.08,
}
#: Counts firms with any late payment, so it is no share of invoices.
NOT_COMPARABLE = ["SMEs Experiencing Any Late Payment (CGIC 2025)"]
BEST_PRACTICE_LATE_RATE = 0.08

# KPI rating thresholds
RAG_VAT_SHARE_BAND = 0.005
RAG_MISMATCH_RED = 0.10
RAG_MISMATCH_AMBER = 0.02
RAG_COMPLIANCE_GREEN = 0.85
RAG_COMPLIANCE_AMBER = 0.65

# Prime lending rate by month, percent; earlier months take the default
PRIME_RATES = {
    "2025-01": 11.25,
    "2025-02": 11.25,
    "2025-03": 11.25,
    "2025-04": 11.25,
    "2025-05": 11.00,
    "2025-06": 11.00,
    "2025-07": 10.75,
    "2025-08": 10.75,
    "2025-09": 10.75,
    "2025-10": 10.75,
    "2025-11": 10.75,
    "2025-12": 10.75,
    "2026-01": 10.75,
    "2026-02": 10.75,
    "2026-03": 10.50,
    "2026-04": 10.50,
    "2026-05": 10.50,
    "2026-06": 10.50,
}
PRIME_RATE_BEFORE_TABLE = 11.75
FINANCING_RATE = Decimal("0.105")

# The six rated indicators, in report order
KPI_NAMES = [
    "Late Payment Rate",
    "Unpaid Invoice Age",
    "YoY Late Payment Trend",
    "VAT Input Tax %",
    "VAT Mismatch Rate",
    "Payment Terms Compliance",
]

# Classifier settings
MODEL_SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
GBT_PARAMS = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.1}
FOREST_PARAMS = {"numTrees": 200, "maxDepth": 6}
LOGISTIC_MAX_ITER = 1000
