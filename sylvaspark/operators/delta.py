"""From one release to the next: new observations, taxon changes and their impact, remapping, import."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BREAKING = ("NEW", "REMOVED", "BREAKING_ANCESTRY", "BREAKING_RANK_LEVEL", "BREAKING_RANK", "BREAKING_DEACTIVATION", "NAME_CHANGE", "REACTIVATION", "NO_CHANGE")
FIELDS = ("ancestry", "rank_level", "rank", "name", "active")


def new_observations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of `new` after the last day of `old`, or with an id that `old` lacks."""
    cutoff = old.agg(F.max("observed_on").alias("_cutoff"))
    known = old.select(F.col("observation_uuid").alias("_known")).distinct()
    joined = new.join(known, F.col("observation_uuid") == F.col("_known"), "left").crossJoin(F.broadcast(cutoff))
    return joined.where((F.col("observed_on") > F.col("_cutoff")) | F.col("_known").isNull()).select(*new.columns)


def _sides(old: DataFrame, new: DataFrame, how: str) -> DataFrame:
    a = old.select(F.col("taxon_id").alias("_a"), *[F.col(c).alias(f"old_{c}") for c in FIELDS])
    b = new.select(F.col("taxon_id").alias("_b"), *[F.col(c).alias(f"new_{c}") for c in FIELDS])
    return a.join(b, F.col("_a") == F.col("_b"), how).withColumn("taxon_id", F.coalesce("_a", "_b"))


def change_class() -> Column:
    """First rule that holds. Differences of a null and a value are none."""
    differs = lambda c: F.col(f"old_{c}") != F.col(f"new_{c}")
    return (
        F.when(F.col("_a").isNull(), "NEW").when(F.col("_b").isNull(), "REMOVED").when(differs("ancestry"), "BREAKING_ANCESTRY").when(differs("rank_level"), "BREAKING_RANK_LEVEL").when(differs("rank"), "BREAKING_RANK")
        .when(F.col("old_active") & ~F.col("new_active"), "BREAKING_DEACTIVATION").when(differs("name"), "NAME_CHANGE").when(~F.col("old_active") & F.col("new_active"), "REACTIVATION").otherwise("NO_CHANGE")
    )


def classify(old: DataFrame, new: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(taxon_id, change, old_*, new_*) for all taxa of both releases, or those of `only` (taxon_id): picked behind the join, as each part of a union before it would be sorted with `only` in one task."""
    out = _sides(old, new, "full_outer").withColumn("change", change_class()).drop("_a", "_b")
    return out if only is None else out.join(only.select("taxon_id").hint("merge"), "taxon_id", "left_semi")


def gate(changes: DataFrame) -> None:
    """Raises if a change breaks what depends on the taxa."""
    bad = changes.where(F.col("change").startswith("BREAKING") | (F.col("change") == "REMOVED")).groupBy("change").count().collect()
    if bad:
        raise ValueError("taxa changed: " + ", ".join(f"{r['change']} {r['count']}" for r in sorted(bad)))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Taxa of both releases with a difference in any field."""
    differs = None
    for c in FIELDS:
        d = F.col(f"old_{c}") != F.col(f"new_{c}")
        differs = d if differs is None else differs | d
    return _sides(old, new, "inner").where(differs).drop("_a", "_b")


def diff_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: new, deprecated, and those whose activity, name or something else changed."""
    n = old.join(new, "taxon_id", "left_anti").agg(F.count("*").alias("deprecated")).crossJoin(new.join(old, "taxon_id", "left_anti").agg(F.count("*").alias("new")))
    both = _sides(old, new, "inner")
    ne = lambda c: F.col(f"old_{c}") != F.col(f"new_{c}")
    return n.crossJoin(both.agg(F.count_if(ne("active")).alias("activity"), F.count_if(ne("name")).alias("name"), F.count_if(ne("ancestry") | ne("rank") | ne("rank_level")).alias("other")))


def mapping(old: DataFrame, new: DataFrame, obs: DataFrame, high: int = 25) -> DataFrame:
    """(taxon_id, change_type, n_obs, high_impact) for taxa that were removed, deactivated, re-ranked or renamed."""
    n = obs.groupBy("taxon_id").agg(F.count("*").alias("n_obs"))
    s = _sides(old, new, "left")
    kind = F.when(F.col("_b").isNull(), "REMOVED").when(F.col("old_active") & ~F.col("new_active"), "DEACTIVATED").when(F.col("old_rank_level") != F.col("new_rank_level"), "RANK_CHANGED").when(F.col("old_name") != F.col("new_name"), "RENAMED")
    out = s.withColumn("change_type", kind).where("change_type is not null").join(n, "taxon_id", "left").withColumn("n_obs", F.coalesce("n_obs", F.lit(0)))
    return out.select("taxon_id", "change_type", F.col("old_name").alias("name"), "old_rank_level", "old_ancestry", "n_obs", (F.col("n_obs") > high).alias("high_impact"))


def remap_rules(old: DataFrame, new: DataFrame, by_hand: DataFrame | None = None, strict_reference: bool = False) -> DataFrame:
    """(old_id, new_id, kind, confidence): taxa re-ranked only; deactivated subspecies to their parent, HIGH if that is active; rules by hand.
    One rule for an old id, in this order. Strict mode looks for the own id in the path, finds none, and has no rules of the second kind."""
    s = _sides(old, new, "inner")
    same = s.where("old_name = new_name and old_rank_level <> new_rank_level and new_active").select(F.col("taxon_id").alias("old_id"), F.col("taxon_id").alias("new_id"), F.lit("RANK_CHANGE_ONLY").alias("kind"), F.lit("HIGH").alias("confidence"), F.lit(0).alias("_o"))
    parent = F.element_at(F.split("old_ancestry", "/"), -1).try_cast("int")
    sub = s.where("old_rank = 'subspecies' and old_active and not new_active").withColumn("_p", F.lit(None).cast("int") if strict_reference else parent).where("_p is not null")
    live = new.select(F.col("taxon_id").alias("_p"), F.col("active").alias("_live"))
    up = sub.join(live, "_p", "left").select(F.col("taxon_id").alias("old_id"), F.col("_p").alias("new_id"), F.lit("SUBSPECIES_TO_SPECIES").alias("kind"), F.when(F.col("_live"), "HIGH").otherwise("LOW").alias("confidence"), F.lit(1).alias("_o"))
    rules = same.unionByName(up)
    if by_hand is not None:
        rules = rules.unionByName(by_hand.select("old_id", "new_id", F.lit("BY_HAND").alias("kind"), "confidence", F.lit(2).alias("_o")))
    first = Window.partitionBy("old_id").orderBy("_o", "new_id")
    return rules.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "_o")


def remap(obs: DataFrame, rules: DataFrame) -> DataFrame:
    """Observations with the new taxon of HIGH rules that aren't identities."""
    use = rules.where("confidence = 'HIGH' and old_id <> new_id").select(F.col("old_id").alias("taxon_id"), "new_id")
    return obs.join(use, "taxon_id", "left").withColumn("taxon_id", F.coalesce("new_id", "taxon_id")).drop("new_id").select(*obs.columns)


def audit(before: DataFrame, after: DataFrame, rules: DataFrame) -> DataFrame:
    """(observation_uuid, old_id, new_id, kind) of rows whose taxon changed."""
    b = before.select("observation_uuid", F.col("taxon_id").alias("old_id"))
    return after.select("observation_uuid", F.col("taxon_id").alias("new_id")).join(b, "observation_uuid").where("old_id <> new_id").join(rules.select("old_id", "kind"), "old_id")


def insert_absent(target: DataFrame, new: DataFrame, key: str, **constants) -> DataFrame:
    """Target and those rows of `new` whose key it lacks, with constant columns (origin, version, release) for the latter."""
    fresh = new.join(target.select(key), key, "left_anti").withColumns({k: F.lit(v) for k, v in constants.items()})
    return target.unionByName(fresh, allowMissingColumns=True)


def suggested_action(rank: str = "rank") -> Column:
    c = F.col(rank)
    return F.when(c == "subspecies", "map to species").when(c == "species", "review synonyms").when(c == "genus", "review children").otherwise("review by hand")
