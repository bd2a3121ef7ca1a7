"""Constraints as reports: what a database would refuse, named."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the rules that are false for them; a rule that is null holds."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("violations", broken).where(F.size("violations") > 0)


def duplicates(df: DataFrame, keys: list[str], nulls_differ: bool = True) -> DataFrame:
    """(keys, n) of keys that come more than once; keys with a null never collide unless told so."""
    if nulls_differ:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no row in the parent table."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def childless(parent: DataFrame, key: str, child: DataFrame, column: str) -> DataFrame:
    """Rows of the parent that no child refers to."""
    return parent.join(child.select(F.col(column).alias("_child")), F.col(key) == F.col("_child"), "left_anti")


def require_one_value(df: DataFrame, key: str, value: str) -> None:
    """Raises if a key has two values."""
    if bad := df.groupBy(key).agg(F.count_distinct(value).alias("n")).where("n > 1").take(1):
        raise ValueError(f"{key} {bad[0][0]!r} has {bad[0][1]} values of {value}")


def require_no_nulls_from_cast(raw: DataFrame, typed: DataFrame, column: str) -> None:
    """Raises if reading lost values of a column (a decimal that overflows is read as null)."""
    a, b = raw.where(F.col(column).isNotNull() & (F.col(column) != "")).count(), typed.where(F.col(column).isNotNull()).count()
    if a != b:
        raise ValueError(f"{a - b} values of {column} don't fit their type")


def touched(rows: DataFrame, now: Column) -> DataFrame:
    """Rows (changed, ...) with updated_at: the time of the write where they changed, null where they stay as they are."""
    return rows.withColumn("updated_at", F.when(F.col("changed"), now))


def gated_write(rows: DataFrame, provenance: DataFrame, edges: DataFrame, now: Column) -> DataFrame:
    """Rows to be written (annotation_id, lifecycle_state, changed, deleted, ...) as the write leaves them, with `refused`: no_provenance where provenance has no row of the id,
    lineage_delete where a row to be deleted is an end of an edge. Superseded rows get that state, changed ones the time."""
    has = provenance.select(F.col("annotation_id").alias("_has")).distinct()
    old = edges.select(F.col("superseded_annotation_id").alias("_old")).distinct()
    w = rows.join(has, F.col("annotation_id") == F.col("_has"), "left").join(old, F.col("annotation_id") == F.col("_old"), "left")
    reasons = F.array_compact(F.array(F.when(F.col("_has").isNull(), "no_provenance"), F.when(F.col("deleted") & F.col("_old").isNotNull(), "lineage_delete")))
    state = F.when(F.col("_old").isNotNull(), "superseded").otherwise(F.col("lifecycle_state"))
    return touched(w.withColumns({"lifecycle_state": state, "refused": reasons}), now).drop("_has", "_old")
