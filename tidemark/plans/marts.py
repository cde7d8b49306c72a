"""Marts: merchants, monthly risk, daily statistics of users, label coverage, the investigation queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import reason_codes, risk_score, risk_tier


def _rate(places: int = 4):
    return F.round(F.count_if("is_fraud") / F.count("*"), places).alias("fraud_rate")


def merchants(facts: DataFrame) -> DataFrame:
    out = facts.filter("merchant_id is not null").groupBy("merchant_id").agg(
        *[F.max(c).alias(c) for c in ("merchant_city", "merchant_state", "mcc")],
        F.count("*").alias("total_txn_count"),
        F.count_if("is_fraud").alias("fraud_txn_count"),
        _rate(),
        F.avg(F.col("amount").cast("double")).alias("avg_amount"),
    )
    return out.withColumn("risk_tier", risk_tier(F.col("fraud_rate")))


def monthly_risk(facts: DataFrame, category: str = "mcc") -> DataFrame:
    """By merchant, month and category: its code, or its text where facts are enriched."""
    by = facts.groupBy("merchant_id", F.year("transaction_date").alias("year"), F.month("transaction_date").alias("month"), category)
    return by.agg(F.count("*").alias("total_txn_count"), F.count_if("is_fraud").alias("fraud_txn_count"), _rate()).withColumn("risk_tier", risk_tier(F.col("fraud_rate")))


def user_days(facts: DataFrame) -> DataFrame:
    amount = F.col("amount").cast("double")
    return facts.groupBy("user_id", F.to_date("transaction_date").alias("day")).agg(
        F.count("*").alias("txn_count"),
        F.sum(amount).alias("amount_sum"),
        F.avg(amount).alias("amount_avg"),
        F.max(amount).alias("amount_max"),
        F.count_if("is_fraud").alias("fraud_txn_count"),
        F.count_distinct("merchant_id").alias("merchants"),
    )


def label_coverage(facts: DataFrame, least: float = 0.8) -> DataFrame:
    """Years of which too few transactions have a label."""
    by = facts.groupBy(F.year("transaction_date").alias("year")).agg(F.round(F.count("is_fraud") / F.count("*"), 6).alias("coverage"))
    return by.filter(F.col("coverage") < least)


def fraud_features(facts: DataFrame, users: DataFrame, features: DataFrame, merchant_dim: DataFrame) -> DataFrame:
    """Facts with the current version of their user, their features and their merchant's risk."""
    current = users.filter("is_current").drop("valid_from", "valid_to", "is_current")
    risk = merchant_dim.select("merchant_id", F.col("fraud_rate").alias("merchant_fraud_rate"), F.col("risk_tier").alias("merchant_risk_tier"))
    return facts.join(current, "user_id", "left").join(features, "transaction_id", "left").join(risk, "merchant_id", "left")


def investigation_queue(facts: DataFrame, features: DataFrame, merchant_dim: DataFrame, score: int = 30) -> DataFrame:
    """Transactions that someone should look at, with a score of 0 to 100 and the reasons for it."""
    risk = merchant_dim.select("merchant_id", F.coalesce("fraud_rate", F.lit(0.0)).alias("merchant_fraud_rate"), F.col("risk_tier").alias("merchant_risk_tier"))
    rows = facts.join(features, "transaction_id", "left").join(risk, "merchant_id", "left")
    rows = rows.withColumns({"risk_score": risk_score(), "reason_codes": reason_codes()})
    return rows.filter(F.coalesce("is_fraud", F.lit(False)) | (F.col("risk_score") >= score) | (F.length("reason_codes") > 0))
