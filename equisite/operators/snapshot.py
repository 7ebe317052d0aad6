"""Self-contained export: unit base with percentiles, sensitivity, allocation, and a manifest that makes them one snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def utc_text(stamp: Column) -> Column:
    """A time as text to the second; the session's zone is UTC (``plans/session.py``)."""
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssXXX")


def snapshot_base(units: DataFrame, wide: DataFrame, scored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Metadata and percentiles of every unit that has a score."""
    kept = scored.select("unit_id").distinct()
    return (units.select("unit_id", *columns).join(kept, "unit_id", "left_semi").join(wide, "unit_id"))


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, checksum) of a relation: the sum of its rows' hashes, whatever their order and partitions.

    Columns are taken by name. A row that is there twice counts twice.
    """
    row = F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def write_snapshot(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write the tables, read them back, and commit them by one file of their names, row counts and checksums.

    The file comes last: a run that is lost half-way leaves a folder that ``read_snapshot`` refuses. A folder is written once.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{folder}/{name}")
        parts.append(fingerprint(spark.read.parquet(f"{folder}/{name}")).select(F.lit(name).alias("table_name"), "n_rows", "checksum"))
    listed = parts[0]
    for part in parts[1:]:
        listed = listed.unionByName(part)
    listed.coalesce(1).write.mode("errorifexists").json(f"{folder}/{COMMIT}")
    return snapshot_tables(spark, folder)


COMMIT = "tables.json"


def snapshot_tables(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, n_rows, checksum) of a committed snapshot; another folder fails."""
    try:
        return spark.read.schema("table_name string, n_rows long, checksum string").json(f"{folder}/{COMMIT}")
    except Exception as exc:
        raise RuntimeError(f"no committed snapshot in {folder}") from exc


def verify_snapshot(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Per table, what was committed and whether the files still hold it; a table that was not committed fails the query."""
    now = None
    for name in names:
        one = fingerprint(spark.read.parquet(f"{folder}/{name}")).select(
            F.lit(name).alias("table_name"), F.col("n_rows").alias("_n"), F.col("checksum").alias("_sum"))
        now = one if now is None else now.unionByName(one)
    unknown = F.raise_error(F.concat(F.lit("not in the snapshot: "), F.col("table_name")))
    same = (F.col("n_rows") == F.col("_n")) & (F.col("checksum") == F.col("_sum"))
    return (now.join(snapshot_tables(spark, folder), "table_name", "left")
            .select("table_name", F.coalesce("n_rows", unknown.cast("long")).alias("n_rows"), same.alias("unchanged")))


def manifest(base: DataFrame, picks: DataFrame, scheme: str, indicators: Sequence[str], sens: DataFrame | None = None) -> DataFrame:
    """One row of provenance; without a sensitivity table there are no regimes."""
    names = picks.agg(F.array_sort(F.collect_set("scenario")).alias("scenarios"))
    if sens is not None:
        names = names.crossJoin(sens.agg(F.array_sort(F.collect_set("regime")).alias("regimes")))
    else:
        names = names.withColumn("regimes", F.array().cast("array<string>"))
    return (base.agg(F.count("*").alias("units")).crossJoin(names)
            .withColumn("scheme", F.lit(scheme))
            .withColumn("indicators", F.array(*[F.lit(k) for k in indicators]))
            .withColumn("exported_at", utc_text(F.current_timestamp())))
