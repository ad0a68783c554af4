"""Column rules: every function takes columns and gives a column, all built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv

MONEY = "decimal(18,2)"


def as_column(c):
    return c if isinstance(c, Column) else F.col(c)


def safe_date(c):
    """Date, or null where the text is no date."""
    return as_column(c).try_cast("date")


def safe_timestamp(c):
    return as_column(c).try_cast("timestamp_ntz")


def money(c):
    return as_column(c).cast(MONEY)


def positive_money(c, allow_zero=False):
    """Amount with two decimals; null where it is negative (or zero, unless allowed)."""
    amount = money(c)
    return F.when(amount >= 0 if allow_zero else amount > 0, amount)


def vat_status(excl, vat, rate=fv.VAT_RATE, tolerance=fv.VAT_TOLERANCE):
    """VALID when the tax is within the tolerance of rate x net, in exact decimal arithmetic."""
    gap = F.abs(money(vat) - money(excl) * F.lit(rate))
    return F.when(gap < F.lit(tolerance), "VALID").otherwise("VAT_MISMATCH")


def vat_mismatch_rounded(excl, vat, rate=fv.VAT_RATE, tolerance=fv.VAT_TOLERANCE):
    """The analysts' variant: expected tax rounded to cents (half to even), compared as doubles.

    At a difference of exactly the tolerance the doubles decide, unlike in `vat_status`. A missing
    amount counts as a mismatch.
    """
    expected = F.rint(money(excl).cast("double") * float(rate) * 100) / 100
    gap = F.abs(money(vat).cast("double") - expected)
    return F.coalesce(gap >= float(tolerance), F.lit(True))


def positive_terms(c):
    days = as_column(c).cast("int")
    return F.when(days > 0, days)


def normalise_status(c):
    raw = as_column(c)
    return F.when(raw.isin(fv.RAW_INVOICE_STATUSES), F.upper(raw)).otherwise("UNKNOWN")


def upper_trim(c):
    return F.upper(F.trim(as_column(c)))


def lower_trim(c):
    return F.lower(F.trim(as_column(c)))


def month_start(c):
    """Grouping key for months: a date, so nothing is formatted per row."""
    return F.trunc(as_column(c), "month")


def month_key(c):
    """``yyyy-MM`` text; meant for grouped rows."""
    return F.date_format(as_column(c), "yyyy-MM")


def derive_vat(excl, rate=fv.VAT_RATE):
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    return F.round(money(excl) * rate, 2).cast(MONEY)


def derive_incl(excl, vat):
    return (money(excl) + money(vat)).cast(MONEY)


def derive_due_date(invoice_date, terms):
    return F.date_add(as_column(invoice_date), as_column(terms))


def derive_days_past_due(due, payment, as_of):
    return F.greatest(F.lit(0), F.datediff(F.coalesce(as_column(payment), as_of), as_column(due)))


def derive_status(is_paid, due, as_of):
    return F.when(as_column(is_paid), "Paid").when(as_of > as_column(due), "Overdue").otherwise("Pending")


def derive_is_late(paid_after_due, is_paid):
    return as_column(paid_after_due) & as_column(is_paid)


def supplier_prior(average, scale=fv.PRIOR_SCALE):
    """Expected share of late payments from the supplier's average invoice value."""
    share = money(average) / F.lit(scale) * F.lit(fv.PRIOR_WEIGHT)
    return F.round(F.lit(fv.PRIOR_BASE) + share, 3).cast("decimal(6,4)")


def days_to_pay():
    return F.datediff("payment_date", "invoice_date")


def has_status(status):
    return F.col("invoice_status") == status


def paid_with_date():
    return has_status("PAID") & F.col("payment_date").isNotNull()


def compliance_class(delta):
    delta = as_column(delta)
    return (
        F.when(delta < fv.EARLY_BELOW_DAYS, "Early")
        .when(delta <= fv.ON_TIME_UP_TO_DAYS, "On-time")
        .otherwise("Late")
    )


def risk_tier(probability):
    p = as_column(probability)
    return F.when(p >= fv.RISK_HIGH, "HIGH").when(p >= fv.RISK_MEDIUM, "MEDIUM").otherwise("LOW")


def band(value, high, medium):
    """HIGH / MEDIUM / LOW by strict thresholds."""
    v = as_column(value)
    return F.when(v > high, "HIGH").when(v > medium, "MEDIUM").otherwise("LOW")


def share(part, whole):
    """Ratio as a double, null on a zero denominator; both sides are exact until the division."""
    return as_column(part).cast("double") / F.nullif(as_column(whole).cast("double"), F.lit(0.0))


def count_where(condition):
    return F.count(F.when(as_column(condition), 1))


def sum_where(condition, value):
    """Conditional sum that is zero, not null, when nothing qualifies."""
    return F.sum(F.when(as_column(condition), as_column(value)).otherwise(0))


def business_days_between(start, end):
    """Weekdays after ``start`` up to and including ``end``, in closed form.

    Day numbers count from a Monday, so whole weeks add five and the rest adds at most five.
    """
    monday = F.lit("1970-01-05").cast("date")

    def weekdays_up_to(day):
        n = F.datediff(as_column(day), monday)
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))

    return (weekdays_up_to(end) - weekdays_up_to(start)).cast("int")
