"""Point-in-time features: what was known of a user before a transaction, without the transaction itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cleaning import is_foreign

HOUR, DAY = 3600, 86400
WEEK = 7


def point_in_time(df: DataFrame) -> DataFrame:
    """df (user_id, transaction_id, transaction_date, amount, merchant_state) with counts and sums of the last hour, day and week,
    the ratio to the mean so far, and calendar flags.

    Frames reach back by whole seconds, the limit included; transactions of the same second count, the row itself doesn't. Rows without a time have none before them.

    Windows are those of a user and day, so that a user of very many rows is spread over as many tasks as days. What they reach back to comes along: time and amount of a row also go
    to the next day and to the day a week later, which are all that frames of a day and a week cut; whole days between, and all days before, come as one row of totals for a user and day.
    """
    rows = df.withColumns({"__at": F.unix_timestamp("transaction_date"), "__own": F.lit(True)}).withColumn("__day", F.floor(F.col("__at") / DAY))
    narrow = rows.filter("__day is not null").select("user_id", "__at", "amount", "__day")
    copies = narrow.withColumns({"__day": F.explode(F.array(F.col("__day") + 1, F.col("__day") + WEEK)), "__own": F.lit(False)})
    days = Window.partitionBy("user_id").orderBy("__day")
    totals = narrow.groupBy("user_id", "__day").agg(F.count("*").alias("n"), F.sum("amount").alias("s"), F.count("amount").alias("c"))
    totals = totals.select(
        "user_id", "__day", F.lit(False).alias("__own"), F.sum("n").over(days.rangeBetween(1 - WEEK, -2)).alias("__week"), *[F.sum(c).over(days.rangeBetween(Window.unboundedPreceding, -1)).alias(f"__{c}") for c in ("s", "c")]
    )
    every = rows.unionByName(copies, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True)

    part = Window.partitionBy("user_id", "__day")
    frames = {k: part.orderBy("__at").rangeBetween(-s, 0) for k, s in {"1h": HOUR, "24h": DAY, "7d": WEEK * DAY}.items()}
    before = part.orderBy("__at", "transaction_id").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("__own"), F.col("amount"))
    known = lambda c: F.coalesce(F.max(c).over(part), F.lit(0))
    out = every.withColumns(
        {f"txn_count_last_{k}": F.count("*").over(w) - 1 + (known("__week") if k == "7d" else 0) for k, w in frames.items()}
        | {f"amount_sum_last_{k}": F.sum("amount").over(frames[k]) - F.col("amount") for k in ("1h", "24h")}
        | {"__s": known("__s") + F.coalesce(F.sum(own).over(before), F.lit(0)), "__c": known("__c") + F.count(own).over(before)}
    )
    out = out.filter("__own").withColumn("user_avg_amount", F.when(F.col("__c") > 0, F.col("__s") / F.col("__c")))
    return out.drop("__at", "__own", "__day", "__week", "__s", "__c").withColumns(
        {
            "amount_vs_user_avg_ratio": F.when(F.col("user_avg_amount") > 0, F.col("amount") / F.col("user_avg_amount")),
            "is_night_txn": F.hour("transaction_date").between(0, 5),
            "is_weekend": F.dayofweek("transaction_date").isin(1, 7),
            "is_foreign_merchant": is_foreign(F.col("merchant_state")),
        }
    )
