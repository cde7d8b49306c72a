"""Column expressions that clean and classify raw text columns. Unreadable values become null; nothing here raises."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error texts by flag, and chip texts by number.
ERRORS = {
    "error_bad_pin": "Bad PIN",
    "error_bad_cvv": "Bad CVV",
    "error_bad_card_number": "Bad Card Number",
    "error_bad_expiration": "Bad Expiration",
    "error_bad_zipcode": "Bad Zipcode",
    "error_insufficient_balance": "Insufficient Balance",
    "error_technical_glitch": "Technical Glitch",
}
CHIP = ("Swipe Transaction", "Chip Transaction", "Online Transaction")
# The fifty states.
US_STATES = [
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS",
    "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]


def bands(value: Column, limits: list[tuple[float, str]], top: str) -> Column:
    """The name of the first limit that value is below, else top; null for null."""
    return reduce(lambda w, x: w.when(value < x[0], x[1]), limits, F.when(value.isNull(), F.lit(None).cast("string"))).otherwise(top)


def plain_money(text: Column) -> Column:
    """Without dollar signs and commas, as double."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def mask_card(number: Column) -> Column:
    """All but the last four digits hidden; fewer digits are filled with zeros; null for null and empty."""
    digits = F.lpad(F.right(F.regexp_replace(number, "[^0-9]", ""), F.lit(4)), 4, "0")
    return F.when(F.coalesce(number, F.lit("")) != "", F.concat(F.lit("XXXX-XXXX-XXXX-"), digits))


def normal_zip(text: Column) -> Column:
    """A number as its whole part in five digits at least; anything else as it is."""
    whole = F.when(text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"), text.try_cast("double")).cast("long")
    shown = whole.cast("string")
    return F.when(whole.isNull(), text).when(F.length(shown) < 5, F.lpad(shown, 5, "0")).otherwise(shown)


def month_year(text: Column) -> tuple[Column, Column]:
    """Month and year of MM/YYYY."""
    return F.split_part(text, F.lit("/"), F.lit(1)).try_cast("int"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("int")


def months_until(text: Column, day: Column) -> Column:
    """Whole months from day to MM/YYYY."""
    month, year = month_year(text)
    return (year - F.year(day)) * 12 + month - F.month(day)


def yes(text: Column) -> Column:
    """True for yes in any case, false for other text, null for null."""
    return F.upper(text) == "YES"


def yes_or_no(text: Column) -> Column:
    """True for yes, false for no, null for anything else."""
    return F.when(F.upper(text) == "YES", True).when(F.upper(text) == "NO", False)


def is_online(state: Column, city: Column) -> Column:
    return state.isNull() & (F.upper(city) == "ONLINE")


def chip_number(text: Column) -> Column:
    return F.coalesce(*[F.when(text == name, F.lit(i)) for i, name in enumerate(CHIP)])


def error_flags(errors: Column) -> dict[str, Column]:
    """A flag for each known error; false for null."""
    return {name: F.coalesce(errors.contains(text), F.lit(False)) for name, text in ERRORS.items()}


def any_of(flags: Iterable[Column]) -> Column:
    return reduce(or_, flags)


def credit_band(score: Column) -> Column:
    named = bands(score, [(300, "INVALID"), (580, "POOR"), (670, "FAIR"), (740, "GOOD"), (800, "VERY_GOOD")], "EXCEPTIONAL")
    return F.when(score > 850, "INVALID").otherwise(named)


def age_group(age: Column) -> Column:
    return bands(age, [(18, "TEEN"), (26, "YOUNG_ADULT"), (41, "ADULT"), (61, "MIDDLE_AGED")], "SENIOR")


def is_foreign(state: Column) -> Column:
    """Whether a state is none of the fifty; null for null."""
    return ~state.isin(US_STATES)


def risk_tier(rate: Column) -> Column:
    return F.when(rate >= 0.10, "CRITICAL").when(rate >= 0.05, "HIGH").when(rate >= 0.02, "MEDIUM").otherwise("LOW")


# What speaks against a transaction: code, points, condition.
def risk_reasons() -> list[tuple[str, int, Column]]:
    at_least = lambda name, x: F.coalesce(F.col(name), F.lit(0)) >= x
    flag = lambda name: F.coalesce(F.col(name), F.lit(False))
    return [
        ("CONFIRMED_FRAUD", 40, flag("is_fraud")),
        ("CARD_ON_DARK_WEB", 25, flag("card_on_dark_web")),
        ("NIGHT_TXN", 10, flag("is_night_txn")),
        ("WEEKEND_TXN", 0, flag("is_weekend")),
        ("FOREIGN_MERCHANT", 10, flag("is_foreign_merchant")),
        ("HIGH_VELOCITY_1H", 15, at_least("txn_count_last_1h", 5)),
        ("AMOUNT_ANOMALY", 15, at_least("amount_vs_user_avg_ratio", 5)),
        ("HIGH_MERCHANT_FRAUD_RATE", 10, at_least("merchant_fraud_rate", 0.05)),
    ]


def risk_score() -> Column:
    return F.least(F.lit(100), reduce(lambda a, b: a + b, (F.when(c, points).otherwise(0) for _, points, c in risk_reasons()))).cast("int")


def reason_codes() -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(c, code) for code, _, c in risk_reasons()])), ",")
