"""Annotations: trust, activity, policies and the best row of each subject and label."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark import registry


def trust_rank(half: float = 0.5) -> Column:
    """0 rejected or in conflict; 3 human, accepted or not reviewed; 2 model accepted with confidence `half` or more, or imported and not rejected; else 1."""
    status, kind = F.coalesce("review_status", F.lit("unreviewed")), F.col("source_kind")
    good = status.isin("accepted", "unreviewed")
    return (
        F.when((status == "rejected") | F.coalesce("conflict_flag", F.lit(False)), 0).when((kind == "human") & good, 3)
        .when((kind == "model") & (status == "accepted") & (F.coalesce("confidence", F.lit(0)) >= half), 2).when((kind == "imported_dataset") & good, 2).otherwise(1)
    )


def active(annotations: DataFrame, edges: DataFrame) -> DataFrame:
    """Active rows that nothing supersedes."""
    return annotations.where("lifecycle_state = 'active'").join(edges, F.col("annotation_id") == F.col("superseded_annotation_id"), "left_anti")


def lifecycle(annotations: DataFrame, edges: DataFrame) -> DataFrame:
    """lifecycle_state with `superseded` where an edge says so."""
    gone = edges.select(F.col("superseded_annotation_id").alias("annotation_id"), F.lit(True).alias("_gone")).distinct()
    return annotations.join(gone, "annotation_id", "left").withColumn("lifecycle_state", F.when(F.col("_gone"), "superseded").otherwise(F.col("lifecycle_state"))).drop("_gone")


def policies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(registry.POLICIES, "policy_name string, policy_version int, strategy string, min_trust_rank int, allowed_source_kinds array<string>, include_conflict boolean")


def source_priority(strategy: Column) -> Column:
    kind = F.col("source_kind")
    order = lambda *names: F.coalesce(*[F.when(kind == n, F.lit(i)) for i, n in enumerate(names)], F.lit(9))
    return F.when(strategy == "human_first", order("human", "imported_dataset", "model")).when(strategy == "model_first", order("model", "human", "imported_dataset")).otherwise(order("human", "model", "imported_dataset"))


def select_best(annotations: DataFrame, edges: DataFrame, policy: str, version: int = 1, set_ids: list | None = None, table: DataFrame | None = None, half: float = 0.5) -> DataFrame:
    """The best annotation of each (subject, label) under a policy, within the given sets (all if none); an unknown policy gives no rows."""
    rule = (policies(SparkSession.active()) if table is None else table).where((F.col("policy_name") == policy) & (F.col("policy_version") == version))
    rows = active(annotations, edges).withColumn("trust_rank", trust_rank(half)).crossJoin(F.broadcast(rule))
    rows = rows.where(F.array_contains("allowed_source_kinds", F.col("source_kind")) & (F.col("trust_rank") >= F.col("min_trust_rank")) & (F.col("include_conflict") | ~F.coalesce("conflict_flag", F.lit(False))) & (F.coalesce("review_status", F.lit("unreviewed")) != "rejected"))
    if set_ids is not None:
        rows = rows.where(F.col("set_id").isin(*set_ids))
    best = Window.partitionBy("subject_id", "label").orderBy("source_priority", F.desc("trust_rank"), F.desc_nulls_last("confidence"), "annotation_id")
    return rows.withColumn("source_priority", source_priority(F.col("strategy"))).withColumn("_rn", F.row_number().over(best)).where("_rn = 1").select(*annotations.columns, "trust_rank", "source_priority")
