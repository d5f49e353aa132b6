"""Column expressions: bands, deterministic buckets, lookups by value, ages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Cuts = Sequence[tuple[float, str]]

# Age bands and waiting bands of the reference data set.
AGE_CUTS: Cuts = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
AGE_LAST = "65+"
WAIT_SHORT_BELOW = 20
WAIT_MEDIUM_UP_TO = 30
# Minutes until a review is written (2 h, 24 h, 5 d).
DELAY_CUTS: Cuts = [(120, "ate 2h"), (1440, "2h a 24h"), (7200, "1 a 5 dias")]
DELAY_LAST = "mais de 5 dias"


def band(value: Column, cuts: Cuts, last: str) -> Column:
    """Label of the first cut that ``value`` lies below; ``last`` above all, NULL for NULL."""
    first_cut, first_label = cuts[0]
    chain = F.when(value < first_cut, first_label)
    for cut, label in cuts[1:]:
        chain = chain.when(value < cut, label)
    return chain.when(value.isNotNull(), last)


def assign_bucket(key: Column, multiplier: int, modulus: int, cuts: Cuts, last: str) -> Column:
    """Split keys into labels with fixed shares: ``pmod(key * multiplier, modulus)`` by cuts.

    When multiplier and modulus are coprime, every run of ``modulus`` keys gets the exact shares.
    """
    return band(spread(key, multiplier, modulus), cuts, last)


def spread(key: Column, multiplier: int, modulus: int | Column) -> Column:
    """``pmod(key * multiplier, modulus)``; the key is reduced first, so that the product of a
    large key does not overflow."""
    size = (modulus if isinstance(modulus, Column) else F.lit(modulus)).cast("long")
    return F.pmod(F.pmod(key.cast("long"), size) * F.lit(multiplier).cast("long"), size)


def wait_band(minutes: Column) -> Column:
    """Short (< 20), medium (20..30, both ends included), long."""
    return (
        F.when(minutes < WAIT_SHORT_BELOW, "<20")
        .when(minutes <= WAIT_MEDIUM_UP_TO, "20..30")
        .when(minutes.isNotNull(), ">30")
    )


def age_band(age: Column) -> Column:
    return band(age, AGE_CUTS, AGE_LAST)


def delay_band(minutes: Column) -> Column:
    return band(minutes, DELAY_CUTS, DELAY_LAST)


def nested_band(outer: Column, value: Column, cuts_of: Mapping[str, Cuts], last: str) -> Column:
    """Label by an outer label first, then by the value against that label's own cuts; NULL for
    outer labels without cuts."""
    label = F.lit(None).cast("string")
    for name, cuts in cuts_of.items():
        label = F.when(outer == name, band(value, cuts, last)).otherwise(label)
    return label


def by_value(value: Column, labels: Mapping[object, object], default: object) -> Column:
    """Simple CASE over the literal values of ``labels``."""
    chain = None
    for match, label in labels.items():
        chain = F.when(value == F.lit(match), F.lit(label)) if chain is None else chain.when(
            value == F.lit(match), F.lit(label))
    return chain.otherwise(F.lit(default))


def pick(options: Sequence[str], position: Column) -> Column:
    """Element of a short literal list at a 0-based position."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (position + 1).cast("int"))


def whole_years(birth: Column, as_of: Column) -> Column:
    """Completed years as days / 365.25, rounded down."""
    return F.floor(F.datediff(as_of, birth) / F.lit(365.25)).cast("int")


def calendar_years(birth: Column, as_of: Column) -> Column:
    """Difference of the calendar years; up to one more than :func:`whole_years`."""
    return F.year(as_of) - F.year(birth)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as a double; NULL where the divisor is 0, as for groups without values."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Percentage as a double."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def mean(value: Column) -> Column:
    """Mean as a double with all digits of the values. For doubles the order of the rows can
    change the last bits, so round it where two runs are compared."""
    return F.avg(value.cast("double"))


def rate(condition: Column) -> Column:
    """Share of rows (0..1) where the condition holds; a NULL condition counts as no."""
    return ratio(F.count_if(condition), F.count("*"))
