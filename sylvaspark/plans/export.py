"""The export as one lazy plan, its parameters, and stages that are kept and used again."""

import hashlib
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from sylvaspark import registry
from sylvaspark.operators import export, taxonomy


@dataclass(frozen=True)
class ExportSpec:
    region: str = "NAfull"
    condition: str = "TRUE"
    min_obs: int = 50
    max_rn: int = 3000
    mode: str = "ALL_EXCLUDE_SPECIES_NON_RESEARCH"
    primary_only: bool = True
    out_of_region: bool = False
    minor_ranks: bool = False
    wipe_levels: tuple = (20, 30, 40)
    wipe_least: int | None = None
    scale: float = 1.0
    strict_reference: bool = False

    def key(self) -> str:
        """Name of a stage: the same parameters, the same name."""
        return hashlib.sha256(repr(sorted(asdict(self).items())).encode()).hexdigest()[:16]


PRESETS = {
    "standard": ExportSpec(),
    "angiospermae": ExportSpec(condition=registry.CLADES["clade"]["angiospermae"], min_obs=60, max_rn=1750),
    "pta_mini": ExportSpec(condition=registry.CLADES["meta"]["pta"], min_obs=200, max_rn=800),
    "pta_tiny": ExportSpec(condition=registry.CLADES["meta"]["pta"], min_obs=50, max_rn=100),
    "pta_non_rg": ExportSpec(condition=registry.CLADES["meta"]["pta"], mode=export.WIPE),
    "pta_multiphoto": ExportSpec(condition=registry.CLADES["meta"]["pta"], primary_only=False, out_of_region=True),
}


def closure_of(gate: DataFrame, wide: DataFrame, spec: ExportSpec) -> DataFrame:
    """Taxa of the export: the closure of each root, united. No roots, no taxa. Roots that overlap are an error."""
    roots = registry.roots(spec.condition, spec.strict_reference)
    if not roots:
        return gate.select("taxon_id").limit(0)
    levels = {}
    if any(level is None for level, _ in roots):
        levels = {r.taxonID: r.rankLevel for r in wide.where(wide["taxonID"].isin(*[i for _, i in roots])).select("taxonID", "rankLevel").collect()}
    out = None
    for level, root in roots:
        top = level if level is not None else levels.get(root, 100.0)
        part = taxonomy.closure(taxonomy.species_of_root(gate, wide, level, root), wide, registry.boundary(top, spec.minor_ranks))
        out = part if out is None else out.union(part)
    return out.distinct()


def run(obs: DataFrame, photos: DataFrame, taxa: DataFrame, spec: ExportSpec, wide: DataFrame | None = None, gate: DataFrame | None = None) -> DataFrame:
    """The sorted export. `wide` and `gate` may be kept stages; `wide` is read several times, so it is best a table."""
    box = registry.region(spec.region)
    box = box if spec.scale == 1 else box.scaled(spec.scale)
    wide = taxonomy.expand(taxa) if wide is None else wide
    gate = export.species_gate(obs, taxa, box, spec.min_obs) if gate is None else gate
    mine = export.with_taxonomy(export.observations_of(obs, closure_of(gate, wide, spec), box, spec.out_of_region), wide, spec.mode)
    if spec.wipe_least:
        for level in spec.wipe_levels:
            mine = export.wipe_rare(mine, level, spec.wipe_least)
    return export.ordered(export.with_photos(export.capped(mine, spec.max_rn), photos, spec.primary_only))


class Stages:
    """Kept tables by parameters: used again if there, not empty and wanted; else built. Files are plain Parquet."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def get(self, name: str, spec: ExportSpec, build, reuse: bool = True) -> DataFrame:
        path = f"{self.folder}/{name}-{spec.key()}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if reuse and hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            kept = self.spark.read.parquet(path)
            if kept.take(1):
                return kept
        build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def gate_spec(spec: ExportSpec) -> ExportSpec:
    """The part of the parameters that the species gate depends on: gates are shared by clades."""
    return replace(ExportSpec(), region=spec.region, min_obs=spec.min_obs, scale=spec.scale)
