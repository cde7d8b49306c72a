"""Tables in Spark's catalogue: external partitioned ones and their repair, bucketed ones, published tables of a lake, and a layer of SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources.lake import NULL_PARTITION, Lake


def external_table(spark: SparkSession, table: str, path: str, schema: StructType, by: list[str]) -> None:
    """A Parquet table of the catalogue over the files at path; partitions that are there are not known until `repair`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts} LOCATION '{path}'")


def repair(spark: SparkSession, table: str, drop: bool = True) -> list[str]:
    """Makes the catalogue know the partition folders that are there, whoever wrote them; with drop it forgets those that are gone. Returns the partitions."""
    spark.sql(f"MSCK REPAIR TABLE {table} {'SYNC' if drop else 'ADD'} PARTITIONS")
    spark.catalog.refreshTable(table)
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def published_table(spark: SparkSession, lake: Lake, zone: str, name: str, table: str) -> None:
    """A table of the catalogue over what a lake has published now; each partition is where the lake says. A partition that was appended to lies in several folders: it has to be
    compacted before."""
    found = lake.state(spark).tables[f"{zone}/{name}"]
    if many := [p for p, v in found.parts.items() if len(v) != 1]:
        raise ValueError(f"{zone}/{name} has partitions in several folders: {many[:3]}")
    base = lake.path(zone, name)
    external_table(spark, table, base if found.by else f"{base}/{found.parts[''][0]}", found.schema, found.by)
    if found.by:
        spec = lambda p: ", ".join(f"{k}={'null' if v == NULL_PARTITION else repr(v)}" for k, v in (x.split("=", 1) for x in p.split("/")))
        parts = [f"PARTITION ({spec(p)}) LOCATION '{base}/{v[0]}/{p}'" for p, v in found.parts.items()]
        for at in range(0, len(parts), 500):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts[at : at + 500])}")


def bucketed_table(rows: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Writes rows as a table of the catalogue, dealt into buckets by a hash of the key and sorted by it, one file for each: tables with as many buckets are joined by the key, again and
    again, without any exchange. A key that a third of all rows have fills one bucket; such a table is better joined without."""
    rows.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


#: Views over published tables, which they find under zone_name; each is plain SQL.
VIEWS = {
    "valid_users": "SELECT user_id, current_age, age_group, credit_score, credit_band, yearly_income FROM staging_users WHERE user_id IS NOT NULL AND NOT credit_invalid",
    "label_impact": "SELECT change_id, transaction_id, event_date, knowledge_date, change_type, old_is_fraud, new_is_fraud FROM audit_impact_manifest WHERE change_type <> 'UNINDEXED'",
    "restatement_report": """SELECT report_date, knowledge_date, max(fraud_txn_count) FILTER (WHERE snapshot_type = 'BEFORE') AS fraud_before, max(fraud_txn_count) FILTER (WHERE snapshot_type = 'AFTER') AS fraud_after,
 max(fraud_amount_sum) FILTER (WHERE snapshot_type = 'AFTER') - max(fraud_amount_sum) FILTER (WHERE snapshot_type = 'BEFORE') AS fraud_amount_change, max(total_txn_count) AS total_txn_count
 FROM audit_report_snapshots GROUP BY report_date, knowledge_date""",
    "batch_reconciliation": "SELECT event_date, raw_count, duplicate_count, accepted_count, quarantined_count, unexplained_difference, invariant_ok FROM audit_reconciliation",
}


def views(spark: SparkSession, lake: Lake) -> list[str]:
    """Registers the published tables as temporary views zone_name, and VIEWS over those that are there; returns the names of these."""
    there = {k.replace("/", "_") for k in lake.state(spark).tables}
    for key in lake.state(spark).tables:
        lake.read(spark, *key.split("/")).createOrReplaceTempView(key.replace("/", "_"))
    made = [name for name, sql in VIEWS.items() if any(f" {t} " in f"{sql} ".replace("\n", " ") for t in there)]
    for name in made:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {VIEWS[name]}")
    return made
