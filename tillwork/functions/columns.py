"""Column expressions shared by the reports. All are built-in functions: no UDF."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------
AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 200]
AGE_LABELS = ["<18", "18–24", "25–34", "35–44", "45–54", "55–64", "65+"]
AGE_TOP_FOR_DISTRIBUTION = 120
UNKNOWN_AGE = "Unknown"

STATUSES = ["Complete", "Shipped", "Processing", "Cancelled", "Returned"]
SOLD = ["Complete", "Shipped"]
COMPLETE = ["Complete"]
RETURNED = "Returned"

SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists",
            "New Customers", "At Risk", "Lost"]
STOCK_TIERS = ["CRITICAL", "WARNING", "NOTICE", "OK"]
ALERT_TIERS = ["CRITICAL", "WARNING"]
LOW_STOCK = 10
NOTICE_STOCK = 30
MARGIN_TOLERANCE = 5
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# -----------------------------------------------------------------------------------


def clean_timestamp(text: Column) -> Column:
    """``2024-01-01 10:00:00.123 UTC`` to a timestamp; null where it is malformed."""
    return F.try_to_timestamp(F.regexp_replace(text, r"\.\d+|\s*UTC\s*$", ""))


def iso_instant(text: Column) -> Column:
    """ISO text with milliseconds and a ``Z`` to a timestamp (the session runs in UTC)."""
    return F.try_to_timestamp(text, F.lit(ISO_INSTANT))


def to_iso_instant(ts: Column) -> Column:
    """The inverse of :func:`iso_instant`."""
    return F.date_format(ts, ISO_INSTANT)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp")))


def days_between(start: Column, end: Column) -> Column:
    """Elapsed time in fractional days."""
    return seconds_between(start, end) / F.lit(86400.0)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_index(month: Column, first_month: Column) -> Column:
    """Number of whole 30-day steps between two ``yyyy-MM`` keys."""
    days = F.datediff(F.to_date(month, "yyyy-MM"), F.to_date(first_month, "yyyy-MM"))
    return F.floor(days / 30).cast("int")


def hundredths(value: Column) -> Column:
    """A double that stands for two decimal places, as a whole number of hundredths.

    Many times faster than a cast of the double to a decimal, which goes through text.
    """
    return F.floor(value * 100 + F.lit(0.5))


def as_money(units: Column, places: int) -> Column:
    """A whole number of ``10 ** -places`` units as an exact decimal(18, places)."""
    unit = F.lit(Decimal(1).scaleb(-places))
    return (units.cast("decimal(18,0)") * unit).cast(f"decimal(18,{places})")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` in doubles, null for an empty whole."""
    return ratio(part, whole) * 100


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding on the decimal digits, so it does not depend on float noise."""
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Mean from an exact (decimal) sum: the division comes last."""
    return ratio(total, count)


def age_band(age: Column, top: int = AGE_EDGES[-1], labels: Sequence[str] = AGE_LABELS) -> Column:
    """Left-closed age bands; null or ``top`` and above is Unknown."""
    band = F.when(age.isNull() | (age >= top), UNKNOWN_AGE)
    for upper, label in zip(AGE_EDGES[1:-1], labels):
        band = band.when(age < upper, label)
    return band.otherwise(labels[-1])


def position_in(value: Column, order: Sequence[str]) -> Column:
    """1-based place of a label in its domain order, null for a foreign label."""
    return F.nullif(F.array_position(F.array(*map(F.lit, order)), value), F.lit(0)).cast("int")


def profit(sale: Column, cost: Column) -> Column:
    return sale - cost


def margin_pct(sale: Column, cost: Column) -> Column:
    """Profit as a percentage of the sale; null unless the sale is positive."""
    return F.when(sale > 0, percent(sale - cost, sale))


def discount_rate(retail: Column, sale: Column) -> Column:
    return F.when(retail > 0, ratio(retail - sale, retail)).otherwise(F.lit(0.0))


def is_discounted(rate: Column) -> Column:
    return flag(rate > 0).cast("double")


def against_average(value: Column, average: Column) -> Column:
    return (F.when(value > average, "Above Average")
            .when(value < average, "Below Average")
            .otherwise("At Average"))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins."""
    rules = [
        ("Champions", (r >= 4) & (f >= 4) & (m >= 4)),
        ("Loyal Customers", (r >= 3) & (f >= 3)),
        ("New Customers", (r >= 4) & (f <= 2)),
        ("At Risk", (r <= 2) & (f >= 3)),
        ("Lost", (r <= 2) & (f <= 2)),
    ]
    return F.coalesce(*(F.when(rule, name) for name, rule in rules), F.lit("Potential Loyalists"))


def stock_tier(available: Column) -> Column:
    critical, warning, notice, ok = STOCK_TIERS
    return (F.when(available == 0, critical)
            .when(available <= LOW_STOCK, warning)
            .when(available <= NOTICE_STOCK, notice)
            .otherwise(ok))


def lost_revenue(available: Column, retail: Column) -> Column:
    """Value of the units missing below the low-stock level."""
    missing = F.lit(LOW_STOCK) - available
    return F.when(available < LOW_STOCK, rounded(missing * retail)).otherwise(F.lit(0.0))


def margin_status(gap: Column) -> Column:
    return (F.when(gap >= 0, "ABOVE_TARGET")
            .when(gap >= -MARGIN_TOLERANCE, "ON_TARGET")
            .otherwise("BELOW_TARGET"))


def correlation_verdict(r: Column) -> Column:
    return F.when(r > 0.4, "positive").when(r < -0.4, "negative").otherwise("weak")


def risk_quadrant(return_rate: Column, return_mid: Column,
                  margin: Column, margin_mid: Column) -> Column:
    often, thin = return_rate >= return_mid, margin < margin_mid
    return (F.when(often & thin, "double risk")
            .when(often, "risky revenue")
            .when(thin, "low value")
            .otherwise("ideal"))
