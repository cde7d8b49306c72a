"""From raw rows to clean ones: transactions, users, cards; and their quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleaning as C
from tidemark.functions.amounts import with_amount
from tidemark.operators.tables import latest, look_up, split


def typed_transactions(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw text columns named, typed and flagged, and the columns keep as they are; every raw row gives one row."""
    parsed = with_amount(raw, "amount", "__a")
    flags = C.error_flags(F.col("errors"))
    # What several columns are made of is a step of its own, so that it is worked out once and no generated method grows beyond what the JVM compiles.
    steps = {"__online": C.is_online(F.col("merchant_state"), F.col("merchant_city")), "__at": F.try_to_timestamp("date", F.lit("yyyy-MM-dd HH:mm:ss"))}
    parsed = parsed.withColumns(steps | {f"__{n}": x for n, x in flags.items()})
    online, at = F.col("__online"), F.col("__at")
    return parsed.select(
        F.col("id").alias("transaction_id"),
        at.alias("transaction_date"),
        F.to_date(at).alias("event_date"),
        F.col("client_id").alias("user_id"),
        "card_id",
        F.col("amount").alias("amount_raw"),
        F.col("__a.amount").alias("amount"),
        F.col("__a.format").alias("amount_format"),
        F.col("__a.currency").alias("amount_currency"),
        F.coalesce(F.col("__a.amount") < 0, F.lit(False)).alias("is_refund"),
        C.chip_number(F.col("use_chip")).alias("use_chip"),
        "merchant_id",
        "merchant_city",
        F.when(online, "ONLINE").otherwise(F.col("merchant_state")).alias("merchant_state"),
        online.alias("is_online"),
        F.when(online, "ONLINE").otherwise(C.normal_zip(F.col("zip"))).alias("zip"),
        F.col("mcc").try_cast("int").alias("mcc"),
        *[F.col(f"__{n}").alias(n) for n in flags],
        C.any_of(F.col(f"__{n}") for n in flags).alias("has_error"),
        *[c for c in raw.columns if c in ("again", "_loaded_at", "_batch_id", *keep)],
    )


def is_valid() -> Column:
    present = F.col("transaction_id").isNotNull() & F.col("transaction_date").isNotNull() & F.col("user_id").isNotNull() & F.col("amount").isNotNull()
    return present & ~F.col("amount_format").isin("AMBIGUOUS", "INVALID")


def clean_transactions(raw: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): of each id the latest row by `order`, split by validity."""
    return split(latest(typed_transactions(raw), ["transaction_id"], order), is_valid())


def enrich(clean: DataFrame, categories: DataFrame, cards: DataFrame, labels: DataFrame) -> DataFrame:
    """With the category's text, the card's facts and the label. The sides are joined by key, broadcast or not as their size says."""
    return add_facts(add_category(clean, categories), cards, labels)


def add_category(clean: DataFrame, categories: DataFrame) -> DataFrame:
    return look_up(clean, categories, "mcc", "mcc_description")


def add_facts(clean: DataFrame, cards: DataFrame, labels: DataFrame) -> DataFrame:
    return clean.join(cards, "card_id", "left").join(labels, "transaction_id", "left")


def clean_users(raw: DataFrame) -> DataFrame:
    money = {c: C.plain_money(F.col(c)) for c in ("per_capita_income", "yearly_income", "total_debt") if c in raw.columns}
    money |= {c: F.col(c).try_cast(t) for c, t in (("latitude", "double"), ("longitude", "double"), ("birth_year", "int"), ("birth_month", "int"), ("retirement_age", "int"), ("num_credit_cards", "int")) if c in raw.columns}
    score, age = F.col("credit_score").try_cast("int"), F.col("current_age").try_cast("int")
    out = raw.withColumnRenamed("id", "user_id").withColumns(money | {"credit_score": score, "current_age": age})
    named = {"credit_band": C.credit_band(F.col("credit_score")), "credit_invalid": F.coalesce((F.col("credit_score") < 300) | (F.col("credit_score") > 850), F.lit(False)), "age_group": C.age_group(F.col("current_age"))}
    return out.withColumns(named).filter("user_id is not null")


def clean_cards(raw: DataFrame, day: Column) -> DataFrame:
    month, year = C.month_year(F.col("expires"))
    return raw.withColumnRenamed("id", "card_id").withColumns(
        {
            "card_number": C.mask_card(F.col("card_number")),
            "expires_month": month,
            "expires_year": year,
            "months_to_expiry": C.months_until(F.col("expires"), day),
            "has_chip": C.yes(F.col("has_chip")),
            "card_on_dark_web": C.yes(F.col("card_on_dark_web")),
            "credit_limit": C.plain_money(F.col("credit_limit")),
        }
    ).drop("cvv").filter("card_id is not null")


def clean_categories(raw: DataFrame) -> DataFrame:
    """(mcc, mcc_description), each code once (the first description in text order); rows without a number for a code go."""
    codes = raw.select(F.col("mcc_code").try_cast("int").alias("mcc"), F.col("description").alias("mcc_description"))
    return codes.filter("mcc is not null").groupBy("mcc").agg(F.min("mcc_description").alias("mcc_description"))


def with_day(df: DataFrame, column: str = "event_date") -> DataFrame:
    """df with the partition columns of a date: year, month, day."""
    return df.withColumns({"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)})


def index_of(clean: DataFrame, at: Column, batch: str) -> DataFrame:
    """The narrow row of each clean transaction that audits look up: whose, when, how much, what label."""
    label = F.col("is_fraud") if "is_fraud" in clean.columns else F.lit(None)
    named = clean.select("transaction_id", "user_id", "event_date", "transaction_date", F.col("amount").cast("double").alias("amount"), label.cast("boolean").alias("is_fraud"), at.alias("_indexed_at"), F.lit(batch).alias("_batch_id"))
    return with_day(named)


def quarantine_rows(bad: DataFrame, at: Column) -> DataFrame:
    """Rows for the quarantine, with empty columns for whoever resolves them."""
    nothing = lambda kind: F.lit(None).cast(kind)
    return with_day(bad.withColumns({"_quarantined_at": at, "resolved_at": nothing("timestamp"), "resolved_by": nothing("string"), "resolution": nothing("string")}))
