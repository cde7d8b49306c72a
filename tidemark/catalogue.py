"""All queries of the library by name, over the driver's tables, with the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cleaning as C
from tidemark.functions.amounts import with_amount
from tidemark.operators import audit, features, tables
from tidemark.plans import marts, transactions
from tidemark.sources.readers import AMOUNT_SQL, json_pairs, raw_transactions, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str, *dates: str):
    """Registers a query and its SQL; dates are compared as text, which both sides write alike."""

    def add(f):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[f.__name__] = query if dates else f
        ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
        return f

    return add


_LABEL = "CASE event_id % 7 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END"
# Facts are events with a merchant, a state and a label derived from their ids.
_FACTS = f"""facts AS (SELECT event_id AS transaction_id, user_id, ts AS transaction_date, CAST(ts AS DATE) AS event_date, value AS amount, event_id % 97 AS merchant_id,
 concat('City', event_id % 5) AS merchant_city, CASE event_id % 5 WHEN 0 THEN 'DC' WHEN 1 THEN NULL ELSE 'NY' END AS merchant_state, 5000 + event_id % 7 AS mcc,
 {_LABEL} AS is_fraud, event_id % 50 = 0 AS card_on_dark_web FROM events)"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as transaction_id", "user_id", "ts as transaction_date", "to_date(ts) as event_date", "value as amount", "event_id % 97 as merchant_id", "concat('City', event_id % 5) as merchant_city",
        "case event_id % 5 when 0 then 'DC' when 1 then null else 'NY' end as merchant_state", "5000 + event_id % 7 as mcc", f"{_LABEL} as is_fraud", "event_id % 50 = 0 as card_on_dark_web",
    )


_PIT = f"""{_FACTS}, e AS (SELECT *, CAST(floor(epoch(transaction_date)) AS BIGINT) AS sec FROM facts),
pit AS (SELECT *, count(*) OVER h - 1 AS txn_count_last_1h, count(*) OVER d - 1 AS txn_count_last_24h, count(*) OVER w - 1 AS txn_count_last_7d,
 sum(amount) OVER h - amount AS amount_sum_last_1h, sum(amount) OVER d - amount AS amount_sum_last_24h,
 avg(amount) OVER (PARTITION BY user_id ORDER BY sec, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS user_avg_amount,
 hour(transaction_date) BETWEEN 0 AND 5 AS is_night_txn, dayofweek(transaction_date) IN (0, 6) AS is_weekend, merchant_state <> 'NY' AS is_foreign_merchant FROM e
 WINDOW h AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW), d AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
 w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)),
f AS (SELECT *, CASE WHEN user_avg_amount > 0 THEN amount / user_avg_amount END AS amount_vs_user_avg_ratio FROM pit)"""


@_query(f"""WITH {_PIT} SELECT transaction_id, txn_count_last_1h, txn_count_last_24h, txn_count_last_7d, round(amount_sum_last_1h, 8) AS amount_sum_last_1h, round(amount_sum_last_24h, 8) AS amount_sum_last_24h,
 round(amount_vs_user_avg_ratio, 8) AS amount_vs_user_avg_ratio, is_night_txn, is_weekend, is_foreign_merchant FROM f""")
def pit_features(spark, sf_dir):
    out = features.point_in_time(facts(spark, sf_dir))
    rounded = [F.round(c, 8).alias(c) for c in ("amount_sum_last_1h", "amount_sum_last_24h", "amount_vs_user_avg_ratio")]
    return out.select("transaction_id", "txn_count_last_1h", "txn_count_last_24h", "txn_count_last_7d", *rounded, "is_night_txn", "is_weekend", "is_foreign_merchant")


# What each notation must give follows from how it was made, not from a parser.
_VALUE = """CASE event_id % 8 WHEN 1 THEN -(n + c / 100.0) WHEN 3 THEN -(n + c / 100.0) WHEN 4 THEN n * 1000.0 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE n + c / 100.0 END"""
_FORMAT = "CASE event_id % 8 WHEN 2 THEN 'EU' WHEN 4 THEN 'VN' WHEN 5 THEN 'INVALID' WHEN 6 THEN 'AMBIGUOUS' ELSE 'CLEAN' END"
_NUMBERS = "n AS (SELECT *, event_id * 7919 % 5000 AS n, event_id * 7919 % 100 AS c FROM events)"
_RAW = AMOUNT_SQL.replace(" as string", " AS VARCHAR")


@_query(f"""WITH {_NUMBERS} SELECT event_id, {_RAW} AS amount_raw, CAST({_VALUE} AS DOUBLE) AS amount, {_FORMAT} AS format,
 CASE WHEN event_id % 8 IN (0, 1, 7) THEN 'USD' WHEN event_id % 8 = 4 THEN 'VND' END AS currency, event_id % 8 IN (1, 3) AS is_negative FROM n""")
def amounts(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr("event_id", f"{AMOUNT_SQL} as amount_raw").repartition(spark.sparkContext.defaultParallelism)
    raw = with_amount(raw, "amount_raw", "a")
    return raw.select("event_id", "amount_raw", F.col("a.amount").cast("double").alias("amount"), "a.format", "a.currency", "a.is_negative")


@_query(f"""WITH {_NUMBERS} SELECT CAST(event_id AS VARCHAR) AS transaction_id, date_trunc('second', ts) AS transaction_date, CAST({_VALUE} AS DOUBLE) AS amount, event_id % 8 IN (1, 3) AS is_refund,
 CAST(event_id % 3 AS INTEGER) AS use_chip, CASE WHEN event_type = 'click' THEN 'ONLINE' WHEN event_id % 5 = 0 THEN 'DC' WHEN event_id % 5 = 1 THEN 'CA' ELSE 'NY' END AS merchant_state,
 event_type = 'click' AS is_online, CASE WHEN event_type = 'click' THEN 'ONLINE' ELSE CASE event_id % 4 WHEN 0 THEN '58523' WHEN 1 THEN '01234' WHEN 3 THEN 'abc' END END AS zip,
 event_id % 11 = 0 AS error_bad_pin, event_id % 11 = 1 AS error_insufficient_balance, event_id % 11 IN (0, 1) AS has_error, CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS again
 FROM n WHERE event_id % 8 NOT IN (5, 6)""")
def clean_transactions(spark, sf_dir):
    clean, _ = transactions.clean_transactions(raw_transactions(spark, sf_dir), [F.desc("again")])
    return clean.select("transaction_id", F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"), F.col("amount").cast("double").alias("amount"), "is_refund", "use_chip", "merchant_state", "is_online", "zip", "error_bad_pin", "error_insufficient_balance", "has_error", "again")


@_query("SELECT CAST(ts AS DATE) AS event_date, CASE event_id % 8 WHEN 5 THEN 'INVALID' ELSE 'AMBIGUOUS' END AS amount_format, count(*) AS n FROM events WHERE event_id % 8 IN (5, 6) GROUP BY ALL", "event_date")
def quarantine(spark, sf_dir):
    _, bad = transactions.clean_transactions(raw_transactions(spark, sf_dir), [F.desc("again")])
    return bad.groupBy("event_date", "amount_format").agg(F.count("*").alias("n"))


@_query("""SELECT CAST(ts AS DATE) AS event_date, count(*) + count(*) FILTER (event_id % 10 = 0) AS raw_count, count(*) FILTER (event_id % 10 = 0) AS duplicate_count,
 count(*) FILTER (event_id % 8 NOT IN (5, 6)) AS accepted_count, count(*) FILTER (event_id % 8 IN (5, 6)) AS quarantined_count, 0 AS unexplained_difference, true AS invariant_ok FROM events GROUP BY ALL""", "event_date")
def reconciliation(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    clean, bad = transactions.clean_transactions(raw, [F.desc("again")])
    return audit.reconcile(transactions.typed_transactions(raw), clean, bad)


@_query("SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate FROM lineitem ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_extendedprice DESC, l_partkey DESC")
def latest_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    return tables.latest(rows, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.desc("l_partkey")])


@_query("""SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE concat('XXXX-XXXX-XXXX-', lpad(CAST(c_custkey * 31 % 10000 AS VARCHAR), 4, '0')) END AS card,
 CASE WHEN s < 300 OR s > 850 THEN 'INVALID' WHEN s < 580 THEN 'POOR' WHEN s < 670 THEN 'FAIR' WHEN s < 740 THEN 'GOOD' WHEN s < 800 THEN 'VERY_GOOD' ELSE 'EXCEPTIONAL' END AS credit_band,
 CASE WHEN a < 18 THEN 'TEEN' WHEN a <= 25 THEN 'YOUNG_ADULT' WHEN a <= 40 THEN 'ADULT' WHEN a <= 60 THEN 'MIDDLE_AGED' ELSE 'SENIOR' END AS age_group,
 CAST((2030 - 2024) * 12 + c_custkey % 12 + 1 - 3 AS INTEGER) AS months_left, c_custkey * 1.5 AS money
 FROM (SELECT *, 250 + c_custkey % 650 AS s, 10 + c_custkey % 80 AS a FROM customer)""")
def user_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", "case when c_custkey % 9 = 0 then null else concat('4111-2222-3333-', lpad(cast(c_custkey * 31 % 10000 as string), 4, '0')) end as number", "250 + c_custkey % 650 as s", "10 + c_custkey % 80 as a", "concat(c_custkey % 12 + 1, '/2030') as expires", "concat('$', c_custkey * 1.5) as money")
    return c.select("c_custkey", C.mask_card(F.col("number")).alias("card"), C.credit_band(F.col("s")).alias("credit_band"), C.age_group(F.col("a")).alias("age_group"), C.months_until(F.col("expires"), F.lit("2024-03-15").cast("date")).alias("months_left"), C.plain_money(F.col("money")).alias("money"))


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE coalesce(p_brand, 'UNKNOWN') END AS p_brand
 FROM lineitem LEFT JOIN part ON p_partkey = CASE WHEN l_partkey % 10 <> 0 AND l_partkey % 3 <> 0 THEN l_partkey END""")
def lookup_default(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "case when l_partkey % 10 <> 0 then l_partkey end as p_partkey")
    return tables.look_up(rows, table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select("p_partkey", "p_brand"), "p_partkey", "p_brand").drop("p_partkey")


_DIM = "SELECT c_custkey, c_mktsegment, DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current FROM customer WHERE c_custkey % 4 <> 0"


def _versions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    dim = c.filter("c_custkey % 4 <> 0").selectExpr("c_custkey", "c_mktsegment", "date'2024-01-01' as valid_from", "date'9999-12-31' as valid_to", "true as is_current")
    now = c.selectExpr("c_custkey", "case when c_custkey % 5 = 0 then 'MOVED' when c_custkey % 7 = 0 then null else c_mktsegment end as c_mktsegment")
    return tables.merge_versions(dim, now, "c_custkey", ["c_mktsegment"], F.lit("2024-01-15").cast("date"))


_SCD = f"""d AS ({_DIM}), s AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer),
ch AS (SELECT s.* FROM s LEFT JOIN d USING (c_custkey) WHERE d.is_current IS NULL OR s.c_mktsegment IS DISTINCT FROM d.c_mktsegment),
v AS (SELECT c_custkey, c_mktsegment, valid_from, CASE WHEN c_custkey IN (SELECT c_custkey FROM ch) THEN DATE '2024-01-15' ELSE valid_to END AS valid_to, c_custkey NOT IN (SELECT c_custkey FROM ch) AS is_current FROM d
 UNION ALL SELECT c_custkey, c_mktsegment, DATE '2024-01-15', DATE '9999-12-31', true FROM ch)"""


@_query(f"WITH {_SCD} SELECT * FROM v", "valid_from", "valid_to")
def scd2_versions(spark, sf_dir):
    return _versions(spark, sf_dir)


@_query(f"WITH {_SCD} SELECT event_id, user_id, ts, c_mktsegment FROM events LEFT JOIN v ON c_custkey = user_id AND ts >= valid_from AND (valid_to IS NULL OR ts < valid_to)")
def version_at_event(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", "user_id", "user_id as c_custkey", "ts")
    return tables.version_at(e, _versions(spark, sf_dir), "c_custkey", "ts", ["c_mktsegment"]).drop("c_custkey")


# Labels known first, then a later delivery that adds, changes and clears some.
_LATER = "CASE WHEN event_id % 7 = 1 AND event_id % 2 = 0 THEN true WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN true ELSE {} END".format(_LABEL)
_CHANGES = f"""{_FACTS}, later AS (SELECT event_id AS transaction_id, {_LATER} AS new_is_fraud FROM events),
ch AS (SELECT transaction_id, event_date, is_fraud AS old_is_fraud, new_is_fraud, CASE WHEN is_fraud IS NULL THEN 'NEW_LABEL' WHEN new_is_fraud IS NULL THEN 'LABEL_CLEARED' ELSE 'LABEL_CHANGED' END AS change_type,
 concat(transaction_id, '-2024-03-01') AS change_id FROM facts JOIN later USING (transaction_id) WHERE is_fraud IS DISTINCT FROM new_is_fraud)"""


def _changes(spark, sf_dir):
    known = facts(spark, sf_dir)
    history = known.selectExpr("transaction_id", "is_fraud", "date'2024-02-01' as knowledge_date", "timestamp'2024-02-01 00:00:00' as _recorded_at")
    older = known.filter("transaction_id % 3 = 0").selectExpr("transaction_id", "not is_fraud as is_fraud", "date'2024-01-01' as knowledge_date", "timestamp'2024-01-01 00:00:00' as _recorded_at")
    labels = table(spark, sf_dir, "events").selectExpr("event_id as transaction_id", f"{_LATER} as is_fraud")
    return known, audit.label_changes(labels, history.unionByName(older), known, F.lit("2024-03-01").cast("date"))


@_query(f"WITH {_CHANGES} SELECT * FROM ch WHERE transaction_id % 4 <> 0", "event_date")
def label_changes(spark, sf_dir):
    _, changes = _changes(spark, sf_dir)
    return audit.pending(changes, changes.filter("transaction_id % 4 = 0").select("change_id")).drop("knowledge_date")


@_query(f"""WITH {_CHANGES}, days AS (SELECT f.*, CASE WHEN c.change_id IS NULL THEN f.is_fraud ELSE c.new_is_fraud END AS after_fraud FROM facts f LEFT JOIN ch c USING (transaction_id) WHERE f.event_date IN (SELECT event_date FROM ch)),
b AS (SELECT event_date, amount, is_fraud, 'BEFORE' AS snapshot_type FROM days UNION ALL SELECT event_date, amount, after_fraud, 'AFTER' FROM days)
SELECT event_date, snapshot_type, count(*) FILTER (is_fraud) AS fraud_txn_count, round(coalesce(sum(amount) FILTER (is_fraud), 0), 8) AS fraud_amount_sum, count(*) AS total_txn_count, round(sum(amount), 8) AS total_amount_sum FROM b GROUP BY ALL""", "event_date")
def restatement(spark, sf_dir):
    rows, changes = _changes(spark, sf_dir)
    return audit.restatement_report(rows, changes).withColumns({c: F.round(c, 8) for c in ("fraud_amount_sum", "total_amount_sum")})


_TIER = "CASE WHEN fraud_rate >= 0.10 THEN 'CRITICAL' WHEN fraud_rate >= 0.05 THEN 'HIGH' WHEN fraud_rate >= 0.02 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier"
_MERCHANTS = f"""m AS (SELECT *, {_TIER} FROM (SELECT merchant_id, max(merchant_city) AS merchant_city, max(merchant_state) AS merchant_state, max(mcc) AS mcc, count(*) AS total_txn_count,
 count(*) FILTER (is_fraud) AS fraud_txn_count, round(count(*) FILTER (is_fraud) / count(*)::DOUBLE, 4) AS fraud_rate, round(avg(amount), 8) AS avg_amount FROM facts GROUP BY merchant_id))"""


@_query(f"WITH {_FACTS}, {_MERCHANTS} SELECT * FROM m")
def merchant_dim(spark, sf_dir):
    return marts.merchants(facts(spark, sf_dir)).withColumn("avg_amount", F.round("avg_amount", 8))


@_query(f"""WITH {_FACTS} SELECT *, {_TIER} FROM (SELECT merchant_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month, mcc, count(*) AS total_txn_count,
 count(*) FILTER (is_fraud) AS fraud_txn_count, round(count(*) FILTER (is_fraud) / count(*)::DOUBLE, 4) AS fraud_rate FROM facts GROUP BY ALL)""")
def merchant_risk(spark, sf_dir):
    return marts.monthly_risk(facts(spark, sf_dir))


@_query(f"""WITH {_FACTS} SELECT user_id, event_date AS day, count(*) AS txn_count, round(sum(amount), 8) AS amount_sum, round(avg(amount), 8) AS amount_avg, max(amount) AS amount_max, count(*) FILTER (is_fraud) AS fraud_txn_count,
 count(DISTINCT merchant_id) AS merchants FROM facts GROUP BY ALL""", "day")
def user_daily_stats(spark, sf_dir):
    return marts.user_days(facts(spark, sf_dir)).withColumns({c: F.round(c, 8) for c in ("amount_sum", "amount_avg")})


@_query(f"WITH {_FACTS} SELECT CAST(year(transaction_date) AS INTEGER) AS year, round(count(is_fraud) / count(*)::DOUBLE, 6) AS coverage FROM facts GROUP BY 1 HAVING count(is_fraud) / count(*)::DOUBLE < 0.9")
def label_coverage(spark, sf_dir):
    return marts.label_coverage(facts(spark, sf_dir), 0.9)


_FEATURES = ["txn_count_last_1h", "txn_count_last_24h", "amount_vs_user_avg_ratio", "is_night_txn", "is_weekend", "is_foreign_merchant"]


@_query(f"""WITH {_PIT}, {_MERCHANTS}, s AS (SELECT f.transaction_id, f.is_fraud, f.amount, m.risk_tier AS merchant_risk_tier,
 CAST(least(100, (CASE WHEN is_fraud THEN 40 ELSE 0 END) + (CASE WHEN card_on_dark_web THEN 25 ELSE 0 END) + (CASE WHEN is_night_txn THEN 10 ELSE 0 END) + (CASE WHEN is_foreign_merchant THEN 10 ELSE 0 END)
 + (CASE WHEN txn_count_last_1h >= 5 THEN 15 ELSE 0 END) + (CASE WHEN amount_vs_user_avg_ratio >= 5 THEN 15 ELSE 0 END) + (CASE WHEN m.fraud_rate >= 0.05 THEN 10 ELSE 0 END)) AS INTEGER) AS risk_score,
 concat_ws(',', CASE WHEN is_fraud THEN 'CONFIRMED_FRAUD' END, CASE WHEN card_on_dark_web THEN 'CARD_ON_DARK_WEB' END, CASE WHEN is_night_txn THEN 'NIGHT_TXN' END, CASE WHEN is_weekend THEN 'WEEKEND_TXN' END,
 CASE WHEN is_foreign_merchant THEN 'FOREIGN_MERCHANT' END, CASE WHEN txn_count_last_1h >= 5 THEN 'HIGH_VELOCITY_1H' END, CASE WHEN amount_vs_user_avg_ratio >= 5 THEN 'AMOUNT_ANOMALY' END,
 CASE WHEN m.fraud_rate >= 0.05 THEN 'HIGH_MERCHANT_FRAUD_RATE' END) AS reason_codes FROM f LEFT JOIN m USING (merchant_id))
 SELECT * FROM s WHERE is_fraud OR risk_score >= 30 OR length(reason_codes) > 0""")
def investigation_queue(spark, sf_dir):
    rows = facts(spark, sf_dir)
    found = features.point_in_time(rows).select("transaction_id", *_FEATURES)
    return marts.investigation_queue(rows, found, marts.merchants(rows)).select("transaction_id", "is_fraud", "amount", "merchant_risk_tier", "risk_score", "reason_codes")


@_query(f"""WITH {_PIT}, {_MERCHANTS}, {_SCD} SELECT f.transaction_id, f.amount, f.is_fraud, v.c_mktsegment, f.txn_count_last_24h, f.is_weekend, m.fraud_rate AS merchant_fraud_rate, m.risk_tier AS merchant_risk_tier
 FROM f LEFT JOIN v ON f.user_id = v.c_custkey AND v.is_current LEFT JOIN m USING (merchant_id)""")
def fraud_features(spark, sf_dir):
    rows = facts(spark, sf_dir)
    found = features.point_in_time(rows).select("transaction_id", *_FEATURES)
    users = _versions(spark, sf_dir).withColumnRenamed("c_custkey", "user_id")
    return marts.fraud_features(rows, users, found, marts.merchants(rows)).select("transaction_id", "amount", "is_fraud", "c_mktsegment", "txn_count_last_24h", "is_weekend", "merchant_fraud_rate", "merchant_risk_tier")


@_query("""SELECT 'lineitem' AS table_name, count(*) AS n_rows, 0 AS null_keys, (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys,
 count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS unaccepted FROM lineitem
 UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderkey % 100 = 0), 0, 0 FROM orders""")
def key_checks(spark, sf_dir):
    lines = audit.key_checks(table(spark, sf_dir, "lineitem"), "lineitem", "l_orderkey", {"l_returnflag": ["A", "N"]})
    orders = table(spark, sf_dir, "orders").selectExpr("case when o_orderkey % 100 <> 0 then o_orderkey end as id")
    return lines.unionByName(audit.key_checks(orders, "orders", "id"))


@_query("SELECT concat('t', event_id) AS key, CASE WHEN event_id % 3 = 0 THEN 'Yes' ELSE 'No' END AS value, event_id % 3 = 0 AS is_fraud FROM events")
def json_labels(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("concat('{\"t', event_id, '\": \"', case when event_id % 3 = 0 then 'Yes' else 'No' end, '\"}') as j", "event_id")
    e = e.withColumn("j", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"target": '), "j", F.lit("}"))).otherwise(F.col("j")))
    return json_pairs(e.unionByName(e.filter("event_id % 5 = 0")), "j").withColumn("is_fraud", C.yes_or_no(F.col("value")))


from tidemark import catalogue_lake  # noqa: E402, F401  what jobs leave on disk, registered here as well
