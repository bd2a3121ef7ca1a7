"""The older region and clade queries."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvaspark.operators import geo
from sylvaspark.registry import Box


def region_taxa(obs: DataFrame, taxa: DataFrame, box: Box, least: int = 50) -> DataFrame:
    """Taxa with an uncontested observation in the box and at least `least` observations anywhere."""
    here = obs.where(geo.overlaps(box)).join(taxa.select("taxon_id", "rank_level"), "taxon_id").where("not (rank_level = 10 and quality_grade <> 'research')").select("taxon_id").distinct()
    many = obs.groupBy("taxon_id").agg(F.count("observation_uuid").alias("n")).where(F.col("n") >= least)
    return here.join(many, "taxon_id", "left_semi")


def region_observations(obs: DataFrame, taxa_ids: DataFrame) -> DataFrame:
    return obs.join(taxa_ids, "taxon_id", "left_semi")


def clade_children(obs: DataFrame, photos: DataFrame, taxa: DataFrame, prefix: str, most: int = 4000, seed: int | None = None) -> DataFrame:
    """Photos of at most `most` observations of each taxon below a path prefix, with the taxon's columns. Observations are taken by the md5 of their
    id, or at random by a seed."""
    below = taxa.where(F.col("ancestry").startswith(prefix)).select("taxon_id", "ancestry", "rank_level", "rank", "name")
    order = [F.md5("observation_uuid"), F.col("observation_uuid")] if seed is None else [F.rand(seed)]
    some = obs.join(below, "taxon_id").withColumn("_rn", F.row_number().over(Window.partitionBy("taxon_id").orderBy(*order))).where(F.col("_rn") <= most).drop("_rn")
    return some.join(photos.drop("observer_id"), "observation_uuid")
