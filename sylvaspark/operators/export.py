"""The training export: species gate, closure, observations, grade filter, rank wipe, cap, photos, order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvaspark import schemas
from sylvaspark.operators import geo, taxonomy
from sylvaspark.registry import Box

BASE_COLUMNS = ["observation_uuid", "observer_id", "latitude", "longitude", "positional_accuracy", "taxon_id", "quality_grade", "observed_on"]
WIPE = "ONLY_NONRESEARCH_WIPE_SPECIES_LABEL"


def obs_columns(release: str, elevation: bool) -> list[str]:
    """Columns of an export by release: elevation if asked for, anomaly score; neither in r0."""
    return BASE_COLUMNS + (["elevation_meters"] if elevation and release != "r0" else []) + (["anomaly_score"] if release != "r0" else [])


def species_gate(obs: DataFrame, taxa: DataFrame, box: Box, min_obs: int) -> DataFrame:
    """Species with at least min_obs research observations in the box, border included: taxon_id, n_obs."""
    species = taxa.where("rank_level = 10").select("taxon_id")
    return obs.where(geo.overlaps(box) & (F.col("quality_grade") == "research")).join(species, "taxon_id", "left_semi").groupBy("taxon_id").agg(F.count("observation_uuid").alias("n_obs")).where(F.col("n_obs") >= min_obs)


def observations_of(obs: DataFrame, taxa_ids: DataFrame, box: Box, out_of_region: bool) -> DataFrame:
    """Observations of those taxa, with in_region: in the box only, or all of them with a strict test."""
    mine = obs.join(taxa_ids, "taxon_id", "left_semi")
    return mine.withColumn("in_region", geo.within(box)) if out_of_region else mine.where(geo.overlaps(box)).withColumn("in_region", F.lit(True))


def grade_condition(mode: str, species: str = "L10_taxonID") -> Column:
    """Condition of a research-grade mode, with SQL's three values: a null grade is dropped where it decides."""
    q, sp = F.col("quality_grade"), F.col(species)
    return {
        "ONLY_RESEARCH": q == "research",
        "ALL_EXCLUDE_SPECIES_NON_RESEARCH": ~((q != "research") & sp.isNotNull()),
        "ONLY_NONRESEARCH": q != "research",
        "ONLY_NONRESEARCH_EXCLUDE_SPECIES": (q != "research") & sp.isNull(),
        WIPE: q != "research",
    }.get(mode, F.lit(True))


def with_taxonomy(obs: DataFrame, wide: DataFrame, mode: str = "ALL") -> DataFrame:
    """Observations of active taxa with rank slots, under a grade mode; the wiping mode hides the species."""
    slots = wide.where("taxonActive").select("taxonID", F.col("rankLevel").alias("taxon_rank_level"), F.col("name").alias("taxon_name"), *taxonomy.SLOT_IDS)
    out = obs.join(slots, obs["taxon_id"] == slots["taxonID"]).drop("taxonID").where(grade_condition(mode))
    return out.withColumn("L10_taxonID", F.lit(None).cast("int")) if mode == WIPE else out


def wipe_rare(df: DataFrame, level: float, least: int) -> DataFrame:
    """Nulls a rank's id where fewer than `least` rows have it."""
    c = f"{schemas.slot(level)}_taxonID"
    rare = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n")).where(F.col("_n") < least).select(F.col(c).alias("_rare"))
    return df.join(rare, F.col(c) == F.col("_rare"), "left").withColumn(c, F.when(F.col("_rare").isNull(), F.col(c))).drop("_rare")


def capped(df: DataFrame, most: int, by: str = "L10_taxonID") -> DataFrame:
    """At most `most` rows of a species: in-region ones first, then by md5 of the id. Rows without a species stay; their rn is null.
    One window and no second scan; the ranks are bounded, so each partition keeps `most` rows of a species before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.desc("in_region"), F.md5("observation_uuid"), "observation_uuid")
    some = df.where(F.col(by).isNotNull()).withColumn("rn", F.row_number().over(w).cast("long")).where(F.col("rn") <= most)
    return some.unionByName(df.where(F.col(by).isNull()).withColumn("rn", F.lit(None).cast("long")))


def with_photos(obs: DataFrame, photos: DataFrame, primary_only: bool) -> DataFrame:
    photos = photos.where("position = 0") if primary_only else photos
    return obs.join(photos.drop("observer_id"), "observation_uuid")


def ordered(df: DataFrame) -> DataFrame:
    return df.orderBy("observation_uuid", F.asc_nulls_last("position"), F.asc_nulls_last("photo_id"), "photo_uuid")


def summary(df: DataFrame) -> DataFrame:
    """Distinct observations, taxa and observers, and the photo figures; the mean is text with two digits, 0.00 for no photos."""
    per = df.groupBy("observation_uuid").agg(F.count("photo_uuid").alias("n"))
    a = df.agg(F.count_distinct("observation_uuid").alias("n_obs"), F.count_distinct("taxon_id").alias("n_taxa"), F.count_distinct("observer_id").alias("n_observers"), F.count("photo_uuid").alias("n_photos"))
    b = per.agg(F.count_if(F.col("n") > 1).alias("n_multi"), F.coalesce(F.max("n"), F.lit(0)).alias("max_photos"))
    mean = F.coalesce(F.try_divide(F.col("n_photos"), F.col("n_obs")), F.lit(0)).cast("decimal(18,2)").cast("string")
    return a.crossJoin(b).withColumn("avg_photos", mean)
