"""Queries of sources, sinks, filters, joins, aggregates, windows, sorting and sets over the roles."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from sylvaspark import registry
from sylvaspark.operators import delta, export, geo, numbering, pairs, resolve, taxonomy
from sylvaspark.plans.export import ExportSpec, Stages, gate_spec
from sylvaspark.plans.export import run as run_export
from sylvaspark.plans.registry import query, scratch
from sylvaspark.sources import files, sinks

NA = registry.region("NAfull").scaled(100)
EUR = registry.region("EURfull").scaled(100)
IN_NA = f"longitude BETWEEN {NA.west} AND {NA.east} AND latitude BETWEEN {NA.south} AND {NA.north}"
IN_EUR = f"longitude BETWEEN {EUR.west} AND {EUR.east} AND latitude BETWEEN {EUR.south} AND {EUR.north}"
STRICT_NA = f"coalesce(longitude > {NA.west} AND longitude < {NA.east} AND latitude > {NA.south} AND latitude < {NA.north}, FALSE)"
TAXA_COLS = "taxon_id, ancestry, rank_level, rank, name, active"

# ---- sources: written in the dump's form and read by the source under test
DUMP = ["observation_uuid", "observer_id", "latitude", "longitude", "positional_accuracy", "taxon_id", "quality_grade", "observed_on", "anomaly_score"]
OBS_BACK = "SELECT observation_uuid, observer_id, latitude, longitude, positional_accuracy, taxon_id, quality_grade, CAST(observed_on AS VARCHAR) AS observed_on, anomaly_score FROM obs"


def _written(r, df, **options):
    path = scratch(r.spark)
    df.write.csv(path, sep="\t", header=True, quote="", nullValue="", emptyValue="", **options)
    return path


def _ints(df, *cols):
    """Whole numbers and days as text: what both engines print alike."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols} | {"observed_on": F.col("observed_on").cast("string")})


@query("src_01_bulk_dump", OBS_BACK)
def _(r):
    return _ints(files.dump(r.spark, _written(r, r.obs.select(DUMP)), "observations", "r1"), "latitude", "longitude", "anomaly_score")


@query("src_02_dump_r0", OBS_BACK.replace(", anomaly_score", ""))
def _(r):
    return _ints(files.dump(r.spark, _written(r, r.obs.select(DUMP[:-1])), "observations", "r0"), "latitude", "longitude")


@query("src_03_dump_r2", OBS_BACK)
def _(r):
    return _ints(files.dump(r.spark, _written(r, r.obs.select(DUMP)), "observations", "r2"), "latitude", "longitude", "anomaly_score")


@query("src_04_staging_like", f"SELECT {TAXA_COLS} FROM taxa")
def _(r):
    return files.staging(r.spark, _written(r, r.taxa), r.taxa).withColumn("ancestry", F.coalesce("ancestry", F.lit("")))


@query("src_05_null_markers", "SELECT observation_uuid, CASE WHEN obs_key % 5 = 0 THEN NULL ELSE quality_grade END AS quality_grade, CASE WHEN obs_key % 7 = 0 THEN NULL ELSE CAST(anomaly_score AS DOUBLE) END AS anomaly_score FROM obs")
def _(r):
    marked = r.obs.withColumns({"quality_grade": F.when(F.col("obs_key") % 5 == 0, F.when(F.col("obs_key") % 2 == 0, "NULL").otherwise(r"\N")).otherwise(F.col("quality_grade")), "anomaly_score": F.when(F.col("obs_key") % 7 == 0, "20000000000").otherwise(F.col("anomaly_score").cast("string"))})
    path = scratch(r.spark)
    marked.select(DUMP).write.csv(path, sep="\t", header=True, quote="", escapeQuotes=False)
    return files.observations_with_markers(r.spark, path).select("observation_uuid", "quality_grade", "anomaly_score")


@query("src_06_split_photos", "SELECT photo_uuid, photo_id, observation_uuid, position FROM photos")
def _(r):
    cols = ["photo_uuid", "photo_id", "observation_uuid", "observer_id", "extension", "license", "width", "height", "position"]
    back = files.dump(r.spark, _written(r, r.photos.select(cols)), "photos")
    return back.select("photo_uuid", F.col("photo_id").cast("bigint").alias("photo_id"), "observation_uuid", F.col("position").cast("int").alias("position"))


@query("src_07_small_table", "SELECT CAST(c_custkey AS INTEGER) AS observer_id, c_name AS login, c_mktsegment AS name FROM customer")
def _(r):
    return files.dump(r.spark, _written(r, r.table("customer").selectExpr("c_custkey observer_id", "c_name login", "c_mktsegment name")), "observers")


@query("src_08_skip_malformed", "SELECT CAST(event_id AS INTEGER) AS id, event_type AS kind FROM events WHERE event_id % 3 <> 0")
def _(r):
    path = scratch(r.spark)
    r.table("events").select(F.concat_ws("\t", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")), "event_type").alias("id\tkind")).write.option("header", True).option("quote", "").csv(path)
    return files.lenient(r.spark, path, "id int, kind string")


@query("src_09_catalogue", "SELECT col_id AS \"ID\", name AS \"scientificName\", rank, status FROM cat")
def _(r):
    df = r.cat.select(F.col("col_id").alias("col:ID"), F.col("name").alias("col:scientificName"), F.coalesce("rank", F.lit("N/A")).alias("col:rank"), F.col("status").alias("col:status"))
    return files.catalogue(r.spark, _written(r, df))


@query("src_11_width_check", "SELECT 'name' AS \"column\", 20 AS width, CAST(max(length(name)) AS INTEGER) AS longest FROM taxa HAVING max(length(name)) > 20")
def _(r):
    return files.too_wide(r.taxa, {"name": 20, "rank": 200})


@query("src_16_pushed_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey < 40")
def _(r):
    return files.parquet(r.spark, f"{r.dir}/orders.parquet", ["o_orderkey", "o_custkey"], "o_custkey < 40")


@query("src_17_page", "SELECT taxon_id, name FROM taxa ORDER BY taxon_id LIMIT 50 OFFSET 20")
def _(r):
    return r.taxa.select("taxon_id", "name").orderBy("taxon_id").offset(20).limit(50)


@query("src_18_short_rows_skipped", "SELECT taxon_id, rank FROM taxa WHERE taxon_id % 9 <> 0")
def _(r):
    path = scratch(r.spark)
    line = F.when(F.col("taxon_id") % 9 == 0, F.concat_ws("\t", F.concat(F.lit("n"), "taxon_id"), F.lit("short"))).otherwise(F.concat_ws("\t", "taxon_id", "rank"))
    r.taxa.select(line.alias("taxon_id\trank")).write.option("header", True).option("quote", "").csv(path)
    return files.lenient(r.spark, path, "taxon_id int, rank string")


@query("src_19_json_lines", "SELECT annotation_id, label, confidence FROM ann")
def _(r):
    path = scratch(r.spark)
    sinks.json_lines(r.ann.select("annotation_id", "label", "confidence"), path)
    return files.json_lines(r.spark, path, "annotation_id bigint, label string, confidence int")


@query("src_20_key_lookup", "SELECT o.observation_uuid, t.name FROM obs o LEFT JOIN taxa t USING (taxon_id)")
def _(r):
    return r.obs.join(r.taxa.select("taxon_id", "name"), "taxon_id", "left").select("observation_uuid", "name")


@query("src_22_value_counts_of_file", "SELECT quality_grade, CAST(count(*) AS BIGINT) AS n FROM obs GROUP BY quality_grade")
def _(r):
    return files.dump(r.spark, _written(r, r.obs.select(DUMP)), "observations").groupBy("quality_grade").agg(F.count("*").alias("n"))


@query("src_23_inline_values", "SELECT t.taxon_id, t.name, v.label FROM taxa t JOIN (VALUES (1000, 'a'), (1001, 'b'), (77, 'c')) AS v(id, label) ON t.taxon_id = v.id")
def _(r):
    return r.taxa.join(F.broadcast(files.values(r.spark, [(1000, "a"), (1001, "b"), (77, "c")], "id int, label string")), F.col("taxon_id") == F.col("id")).select("taxon_id", "name", "label")


@query("src_24_id_list", "SELECT DISTINCT c_custkey % 500 AS id FROM customer")
def _(r):
    path = scratch(r.spark)
    r.table("customer").select((F.col("c_custkey") % 500).cast("string")).union(r.spark.createDataFrame([("not a number",)], "x string")).write.text(path)
    return files.id_list(r.spark, path)


# ---- sinks: written by the sink under test and read back
@query("snk_01_sorted_export", "SELECT observation_uuid, photo_uuid, position FROM photos WHERE position = 0")
def _(r):
    path = scratch(r.spark)
    sinks.sorted_tsv(r.photos.where("position = 0").select("observation_uuid", "photo_uuid", "position"), path, "observation_uuid", "photo_uuid")
    return r.spark.read.csv(path, schema="observation_uuid string, photo_uuid string, position int", sep="\t", header=True)


@query("snk_02_create_table_as", f"SELECT {TAXA_COLS} FROM taxa WHERE active")
def _(r):
    return sinks.table(r.taxa.where("active"), scratch(r.spark))


@query("snk_03_stage_reuse", f"SELECT o.taxon_id, CAST(count(*) AS BIGINT) AS n_obs FROM obs o JOIN taxa t USING (taxon_id) WHERE {IN_NA} AND quality_grade = 'research' AND rank_level = 10 GROUP BY o.taxon_id HAVING count(*) >= 2")
def _(r):
    stages, spec = Stages(r.spark, scratch(r.spark)), gate_spec(SPEC)
    stages.get("gate", spec, lambda: export.species_gate(r.obs, r.taxa, NA, 2))

    def never():
        raise AssertionError("the stage is there")

    return stages.get("gate", spec, never)


@query("snk_05_csv_report", "SELECT taxon_id, name FROM taxa WHERE NOT active")
def _(r):
    path = scratch(r.spark)
    sinks.csv_report(r.taxa.where("not active").select("taxon_id", "name"), path)
    return r.spark.read.csv(path, schema="taxon_id int, name string", header=True)


@query("snk_06_manifest_csv", "SELECT row_id, filename, id_core FROM manifest")
def _(r):
    path = scratch(r.spark)
    r.manifest.select("row_id", "filename", "id_core").write.csv(path, header=True)
    return files.manifest(r.spark, path).withColumn("row_id", F.col("row_id").cast("bigint"))


MEDIA_NEW = "SELECT 5000000 + row_id AS media_id, sha256, 'file:///n' || row_id AS uri, 'CC0' AS license FROM manifest WHERE sha256 IN (SELECT sha256 FROM media) OR row_id % 97 = 0 AND sha256 IS NOT NULL"


@query("snk_07_upsert", f"WITH n AS (SELECT min(media_id) AS media_id, sha256, min(uri) AS uri, 'CC0' AS license FROM ({MEDIA_NEW}) GROUP BY sha256) SELECT * FROM n UNION ALL SELECT * FROM media WHERE sha256 NOT IN (SELECT sha256 FROM n)")
def _(r):
    known = r.media.select("sha256").distinct()
    new = r.manifest.where("sha256 is not null").join(known.withColumn("_k", F.lit(True)), "sha256", "left").where("_k or row_id % 97 = 0")
    new = new.groupBy("sha256").agg(F.min(F.col("row_id") + 5000000).alias("media_id"), F.min(F.concat(F.lit("file:///n"), "row_id")).alias("uri"), F.first(F.lit("CC0")).alias("license"))
    return resolve.upsert(r.media, new.select(r.media.columns), "sha256")


@query("snk_08_insert_absent", "SELECT taxon_id, name FROM taxa UNION ALL SELECT taxon_id, name FROM taxa2 WHERE taxon_id NOT IN (SELECT taxon_id FROM taxa)")
def _(r):
    return delta.insert_absent(r.taxa.select("taxon_id", "name"), r.taxa2.select("taxon_id", "name"), "taxon_id")


@query("snk_09_full_refresh", "SELECT taxon_id, col_id FROM xwalk")
def _(r):
    path = scratch(r.spark)
    sinks.table(r.xwalk.where("taxon_id < 2000"), path)
    return sinks.table(r.xwalk, path)


@query("snk_11_json_lines", "SELECT taxon_id, ancestry FROM taxa")
def _(r):
    path = scratch(r.spark)
    sinks.json_lines(r.taxa.select("taxon_id", "ancestry"), path)
    return r.spark.read.json(path, schema="taxon_id int, ancestry string")


@query("snk_14_fixture_extract", "SELECT taxon_id, name FROM taxa WHERE taxon_id IN (1000, 2003, 30010) OR name IN ('ASIA', 'NATION_7')")
def _(r):
    return r.taxa.where(F.col("taxon_id").isin(1000, 2003, 30010) | F.col("name").isin("ASIA", "NATION_7")).select("taxon_id", "name")


@query("snk_16_counts", "SELECT 'taxa' AS \"table\", count(*) AS n FROM taxa UNION ALL SELECT 'obs', count(*) FROM obs UNION ALL SELECT 'photos', count(*) FROM photos")
def _(r):
    return sinks.counts(taxa=r.taxa, obs=r.obs, photos=r.photos)


# ---- filters
def _cols(release, flag):
    return [c for c in export.obs_columns(release, flag) if c != "elevation_meters"]


@query("flt_01_release_columns", "SELECT observation_uuid, observer_id, latitude, longitude, positional_accuracy, taxon_id, quality_grade, CAST(observed_on AS VARCHAR) AS observed_on, anomaly_score FROM obs")
def _(r):
    return _ints(r.obs.select(_cols("r1", False)))


@query("flt_02_release_columns_r0", "SELECT observation_uuid, observer_id, latitude, longitude, positional_accuracy, taxon_id, quality_grade, CAST(observed_on AS VARCHAR) AS observed_on FROM obs")
def _(r):
    return _ints(r.obs.select(_cols("r0", True)))


WIDE5 = ', '.join(f'"{s}_taxonID"' for s in ("L5", "L10", "L20", "L40", "L70"))
SLOTS5 = [f"{s}_taxonID" for s in ("L5", "L10", "L20", "L40", "L70")]


@query("flt_03_taxonomy_projection", f'SELECT "taxonID", "rankLevel" AS taxon_rank_level, name AS taxon_name, {WIDE5} FROM wide')
def _(r):
    return r.wide.select("taxonID", F.col("rankLevel").alias("taxon_rank_level"), F.col("name").alias("taxon_name"), *SLOTS5)


MODES = {
    "flt_04_only_research": ("ONLY_RESEARCH", "quality_grade = 'research'"),
    "flt_05_all": ("ALL", "TRUE"),
    "flt_06_exclude_species_non_research": ("ALL_EXCLUDE_SPECIES_NON_RESEARCH", "NOT (quality_grade <> 'research' AND \"L10_taxonID\" IS NOT NULL)"),
    "flt_07_only_nonresearch": ("ONLY_NONRESEARCH", "quality_grade <> 'research'"),
    "flt_08_nonresearch_exclude_species": ("ONLY_NONRESEARCH_EXCLUDE_SPECIES", "quality_grade <> 'research' AND \"L10_taxonID\" IS NULL"),
    "flt_09_nonresearch_wipe_label": (export.WIPE, "quality_grade <> 'research'"),
}
for _name, (_mode, _where) in MODES.items():
    _l10 = "CAST(NULL AS INTEGER)" if _mode == export.WIPE else '"L10_taxonID"'
    query(_name, f'SELECT observation_uuid, quality_grade, {_l10} AS "L10_taxonID", "L20_taxonID" FROM obs o JOIN wide w ON w."taxonID" = o.taxon_id WHERE {_where}')(lambda r, m=_mode: export.with_taxonomy(r.obs, r.wide, m).select("observation_uuid", "quality_grade", "L10_taxonID", "L20_taxonID"))


@query("flt_10_active_taxa", "SELECT o.observation_uuid, o.taxon_id FROM obs o JOIN taxa t USING (taxon_id) WHERE t.active")
def _(r):
    return r.obs.join(r.taxa.where("active").select("taxon_id"), "taxon_id").select("observation_uuid", "taxon_id")


@query("flt_11_box_overlap", f"SELECT observation_uuid FROM obs WHERE {IN_NA}")
def _(r):
    return r.obs.where(geo.overlaps(NA)).select("observation_uuid")


@query("flt_12_strictly_within", f"SELECT observation_uuid, {STRICT_NA} AS in_region FROM obs")
def _(r):
    return r.obs.select("observation_uuid", geo.within(NA).alias("in_region"))


def _region_counts(r):
    return [(tag, registry.region(tag).scaled(100)) for tag in sorted(registry.REGIONS)]


@query("flt_13_region_predicates", " UNION ALL ".join(f"SELECT '{t}' AS region, count(*) AS n FROM obs WHERE longitude BETWEEN {b.west} AND {b.east} AND latitude BETWEEN {b.south} AND {b.north}" for t, b in _region_counts(None)))
def _(r):
    hits = F.array_compact(F.array(*[F.when(geo.overlaps(b), F.lit(t)) for t, b in _region_counts(r)]))
    tags = r.spark.createDataFrame([(t,) for t in sorted(registry.REGIONS)], "region string")
    return tags.join(r.obs.select(F.explode(hits).alias("region")).groupBy("region").agg(F.count("*").alias("n")), "region", "left").select("region", F.coalesce("n", F.lit(0)).alias("n"))


@query("flt_14_contested", "SELECT o.observation_uuid FROM obs o JOIN taxa t USING (taxon_id) WHERE NOT (rank_level = 10 AND quality_grade <> 'research')")
def _(r):
    return r.obs.join(r.taxa.select("taxon_id", "rank_level"), "taxon_id").where("not (rank_level = 10 and quality_grade <> 'research')").select("observation_uuid")


_BOXED = {tag: registry.region(tag).scaled(100) for tag in registry.REGIONS}


@query("flt_15_region_lookup", " UNION ALL ".join(f"SELECT '{t}' AS tag, count(*) AS n FROM obs WHERE longitude BETWEEN {b.west} AND {b.east} AND latitude BETWEEN {b.south} AND {b.north}" for t, b in _BOXED.items()))
def _(r):
    """Observations in each region; one pass over the table for all of them."""
    inside = [F.struct(F.lit(t).alias("tag"), F.count_if(geo.overlaps(b)).alias("n")) for t, b in _BOXED.items()]
    return r.obs.agg(F.array(*inside).alias("a")).select(F.inline("a"))


@query("flt_16_clade_condition", "SELECT taxon_id FROM taxa WHERE taxon_id = 47158 OR taxon_id = 47119 OR rank_level = 70")
def _(r):
    ids = [i for _, i in registry.roots(registry.clade_condition(meta="pta", clade="aves"))]
    return r.taxa.where(F.col("taxon_id").isin(*ids) | (F.col("rank_level") == 70)).select("taxon_id")


@query("flt_17_clade_roots", 'SELECT "taxonID" FROM wide WHERE "L40_taxonID" = 2003 OR "L20_taxonID" = 30041 OR "taxonID" = 100007 OR "L10_taxonID" = 100012')
def _(r):
    """The taxa below the roots that are parsed from an expression."""
    roots = registry.roots('"L40_taxonID" = 2003 OR L20_taxonID=30041 OR "taxonID" = 100007 OR "L10_taxonID" = 100012')
    below = [F.col("taxonID" if level is None else f"L{level:g}_taxonID") == i for level, i in roots]
    return r.wide.where(reduce(lambda a, b: a | b, below)).select("taxonID")


@query("flt_18_path_prefix", "SELECT taxon_id FROM taxa WHERE ancestry LIKE '1001/2001/%'")
def _(r):
    return r.taxa.where(F.col("ancestry").startswith("1001/2001/")).select("taxon_id")


@query("flt_19_path_contains", "SELECT taxon_id FROM taxa WHERE ancestry LIKE '%/2001/%'")
def _(r):
    return r.taxa.where(F.col("ancestry").contains("/2001/")).select("taxon_id")


@query("flt_20_membership", "SELECT observation_uuid FROM obs WHERE taxon_id IN (SELECT taxon_id FROM taxa WHERE rank_level = 20)")
def _(r):
    return r.obs.join(r.taxa.where("rank_level = 20"), "taxon_id", "left_semi").select("observation_uuid")


@query("flt_21_absence", "SELECT observation_uuid FROM obs o WHERE NOT EXISTS (SELECT 1 FROM photos p WHERE p.observation_uuid = o.observation_uuid)")
def _(r):
    return r.obs.join(r.photos, "observation_uuid", "left_anti").select("observation_uuid")


@query("flt_22_primary_photo", "SELECT photo_id FROM photos WHERE position = 0")
def _(r):
    return r.photos.where("position = 0").select("photo_id")


@query("flt_23_vernacular", "SELECT col_id, name FROM vern WHERE language = 'eng' AND (preferred OR preferred IS NULL)")
def _(r):
    return r.vern.where("language = 'eng' and (preferred or preferred is null)").select("col_id", "name")


@query("flt_24_public_license", "SELECT media_id FROM media WHERE license IS NULL OR license NOT IN ('unknown', 'restricted', 'all-rights-reserved')")
def _(r):
    return r.media.where(F.col("license").isNull() | ~F.col("license").isin("unknown", "restricted", "all-rights-reserved")).select("media_id")


@query("flt_25_changed", "SELECT a.taxon_id FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.ancestry <> b.ancestry OR a.rank_level <> b.rank_level OR a.rank <> b.rank OR a.name <> b.name OR a.active <> b.active")
def _(r):
    return delta.changed(r.taxa, r.taxa2).select("taxon_id")


@query("flt_26_policy_candidates", "SELECT annotation_id FROM ann WHERE list_contains(['human', 'model'], source_kind) AND coalesce(confidence, 0) >= 40 AND NOT coalesce(conflict_flag, FALSE) AND coalesce(review_status, 'unreviewed') <> 'rejected' AND set_id IN (1, 2)")
def _(r):
    kinds = F.array(F.lit("human"), F.lit("model"))
    return r.ann.where(F.array_contains(kinds, F.col("source_kind")) & (F.coalesce("confidence", F.lit(0)) >= 40) & ~F.coalesce("conflict_flag", F.lit(False)) & (F.coalesce("review_status", F.lit("unreviewed")) != "rejected") & F.col("set_id").isin(1, 2)).select("annotation_id")


@query("flt_27_keep_flag", "SELECT event_id, event_id % 4 IN (0, 1, 2) AS keep FROM events")
def _(r):
    from sylvaspark.functions import scalar

    flag = F.element_at(F.array(F.lit("True"), F.lit("1"), F.lit("YES"), F.lit("no")), (F.col("event_id") % 4 + 1).cast("int"))
    return r.table("events").select("event_id", scalar.to_bool(flag).alias("keep"))


@query("flt_28_name_search", "SELECT taxon_id FROM taxa WHERE lower(name) LIKE 'nation_1%' AND lower(name) LIKE 'nation\\_1%' ESCAPE '\\' AND rank_level = 20")
def _(r):
    return taxonomy.search(r.taxa, "NATION_1", 20).select("taxon_id")


@query("flt_29_file_predicate", "SELECT page_id FROM pages WHERE url LIKE '%.com/%' AND url NOT LIKE '%?%'")
def _(r):
    return r.table("pages").where(F.col("url").contains(".com/") & ~F.col("url").contains("?")).select("page_id")


SIM = "100.0::DOUBLE - 100.0::DOUBLE * levenshtein(a, b) / greatest(length(a), length(b))"
NORM = "trim(regexp_replace(lower(name), '\\s+', ' ', 'g'))"
FUZZY = f"""
WITH a AS (SELECT taxon_id, {NORM} AS a FROM names), b AS (SELECT col_id, {NORM} AS b FROM cat),
p AS (SELECT taxon_id, col_id, {SIM} AS score FROM a, b WHERE a <> '' AND b <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY taxon_id ORDER BY score DESC, col_id) AS rn FROM p WHERE score >= 90)
SELECT taxon_id, col_id, score FROM r WHERE rn <= 5"""


@query("flt_30_score_threshold", FUZZY.replace("rn <= 5", "rn <= 5 AND score > 93"))
def _(r):
    return resolve.fuzzy_candidates(r.names, r.cat).where("score > 93")


# ---- joins
@query("jon_01_obs_taxa", "SELECT observation_uuid, rank FROM obs JOIN taxa USING (taxon_id)")
def _(r):
    return r.obs.join(r.taxa.select("taxon_id", "rank"), "taxon_id").select("observation_uuid", "rank")


@query("jon_02_obs_expanded", 'SELECT observation_uuid, "L40_taxonID" FROM obs JOIN wide ON "taxonID" = taxon_id')
def _(r):
    return r.obs.join(r.wide.select("taxonID", "L40_taxonID"), F.col("taxonID") == F.col("taxon_id")).select("observation_uuid", "L40_taxonID")


@query("jon_03_obs_photos", "SELECT observation_uuid, photo_id FROM obs JOIN photos USING (observation_uuid)")
def _(r):
    return r.obs.join(r.photos, "observation_uuid").select("observation_uuid", "photo_id")


@query("jon_04_semi", "SELECT taxon_id FROM taxa WHERE taxon_id IN (SELECT taxon_id FROM obs)")
def _(r):
    return r.taxa.join(r.obs, "taxon_id", "left_semi").select("taxon_id")


@query("jon_05_anti", "SELECT taxon_id FROM taxa WHERE taxon_id NOT IN (SELECT taxon_id FROM obs)")
def _(r):
    return r.taxa.join(r.obs, "taxon_id", "left_anti").select("taxon_id")


@query("jon_06_null_test", "SELECT annotation_id FROM ann LEFT JOIN edge ON annotation_id = superseded_annotation_id WHERE superseded_annotation_id IS NULL")
def _(r):
    return r.ann.join(r.edge, F.col("annotation_id") == F.col("superseded_annotation_id"), "left_anti").select("annotation_id")


@query("jon_07_left_enrich", "SELECT taxon_id, n FROM taxa LEFT JOIN (SELECT taxon_id, count(*) AS n FROM obs GROUP BY taxon_id) USING (taxon_id)")
def _(r):
    return r.taxa.join(r.obs.groupBy("taxon_id").agg(F.count("*").alias("n")), "taxon_id", "left").select("taxon_id", "n")


@query("jon_08_full_outer", "SELECT coalesce(a.taxon_id, b.taxon_id) AS taxon_id, a.name AS old_name, b.name AS new_name FROM taxa a FULL JOIN taxa2 b ON a.taxon_id = b.taxon_id")
def _(r):
    return delta.classify(r.taxa, r.taxa2).select("taxon_id", "old_name", "new_name")


@query("jon_09_cross_one_row", "SELECT annotation_id, label, 2 AS floor FROM ann")
def _(r):
    return r.ann.crossJoin(F.broadcast(r.spark.createDataFrame([(2,)], "floor int"))).select("annotation_id", "label", "floor")


@query("jon_10_unpivot_join", 'SELECT sp, anc, "rankLevel" FROM line JOIN wide ON wide."taxonID" = anc')
def _(r):
    levels = r.wide.select(F.col("taxonID").alias("anc"), "rankLevel")
    return taxonomy.slots_long(r.wide).withColumnRenamed("taxonID", "sp").join(levels, "anc").select("sp", "anc", "rankLevel")


GRID = "SELECT observation_uuid, CASE WHEN elevation = -9999 THEN NULL ELSE elevation END AS elevation FROM obs LEFT JOIN cells ON ix = CAST(floor((longitude + 18000) / 1000.0) AS INTEGER) AND iy = CAST(floor((latitude + 9000) / 1000.0) AS INTEGER)"


@query("jon_11_grid_join", GRID + " WHERE elevation IS NOT NULL AND elevation <> -9999")
def _(r):
    return geo.sample_grid(r.obs, r.cells, -18000, -9000, 1000).where("elevation is not null").select("observation_uuid", "elevation")


@query("jon_12_left_lateral", GRID)
def _(r):
    return geo.sample_grid(r.obs, r.cells, -18000, -9000, 1000).select("observation_uuid", "elevation")


IMM = """CASE WHEN "rankLevel" < 10 AND L10_taxonID IS NOT NULL THEN L10_taxonID WHEN "rankLevel" < 20 AND L20_taxonID IS NOT NULL THEN L20_taxonID WHEN "rankLevel" < 40 AND L40_taxonID IS NOT NULL THEN L40_taxonID WHEN "rankLevel" < 70 THEN L70_taxonID END"""


@query("jon_13_parent_self_join", f'SELECT c."taxonID", p.name AS parent FROM (SELECT *, {IMM} AS up FROM wide) c LEFT JOIN wide p ON p."taxonID" = c.up')
def _(r):
    up, _ = taxonomy.immediate_ancestor()
    parents = r.wide.select(F.col("taxonID").alias("up"), F.col("name").alias("parent"))
    return r.wide.select("taxonID", up.alias("up")).join(parents, "up", "left").select("taxonID", "parent")


@query("jon_14_null_safe_merge", f"SELECT n.taxon_id, c.col_id FROM names n JOIN cat c ON {NORM.replace('name', 'n.name')} = {NORM.replace('name', 'c.name')} AND lower(n.rank) IS NOT DISTINCT FROM lower(c.rank)")
def _(r):
    from sylvaspark.functions import scalar

    safe = lambda c, name: [F.coalesce(c, F.lit("")).alias(f"_{name}"), c.isNull().alias(f"_{name}_null")]
    keys = [*safe(scalar.normalise_name("name"), "name"), *safe(F.lower("rank"), "rank")]
    return pairs.pairs(r.names.select("taxon_id", *keys), r.cat.select("col_id", *keys), "_name", "_name_null", "_rank", "_rank_null").select("taxon_id", "col_id")


@query("jon_15_fuzzy", FUZZY)
def _(r):
    return resolve.fuzzy_candidates(r.names, r.cat)


@query("jon_16_update_join", "SELECT o.observation_uuid, coalesce(t.taxon_id + 1, o.taxon_id) AS taxon_id FROM obs o LEFT JOIN (SELECT taxon_id FROM taxa WHERE rank_level = 20) t USING (taxon_id)")
def _(r):
    new = r.taxa.where("rank_level = 20").select("taxon_id", (F.col("taxon_id") + 1).alias("_new"))
    return r.obs.join(new, "taxon_id", "left").select("observation_uuid", F.coalesce("_new", "taxon_id").alias("taxon_id"))


@query("jon_18_id_match", "SELECT row_id FROM manifest WHERE id_core IN (SELECT photo_id FROM photos)")
def _(r):
    return r.manifest.join(r.photos.select(F.col("photo_id").alias("id_core")), "id_core", "left_semi").select("row_id")


@query("jon_19_lower_name", "SELECT p_partkey, col_id FROM part JOIN cat ON lower(p_name) = lower(name)")
def _(r):
    return _by_lower_name(r.table("part"), r.cat)


def _by_lower_name(part, cat):
    return pairs.pairs(part.select("p_partkey", F.lower("p_name").alias("_name")), cat.select("col_id", F.lower("name").alias("_name")), "_name").select("p_partkey", "col_id")


@query("jon_20_root_overlap", "SELECT CAST(a AS INTEGER) AS root_a, CAST(b AS INTEGER) AS root_b, CAST(t AS INTEGER) AS taxon_id FROM (VALUES (2001, 30010, 2001), (2001, 30010, 1001)) AS v(a, b, t)")
def _(r):
    return taxonomy.root_overlaps(r.wide, [(70.0, 1001), (40.0, 2001), (20.0, 30010)]).where("root_a = 2001 and root_b = 30010")


@query("jon_21_correlated_count", "SELECT t.taxon_id, (SELECT count(*) FROM obs o WHERE o.taxon_id = t.taxon_id) AS n FROM taxa t")
def _(r):
    n = r.obs.groupBy("taxon_id").agg(F.count("*").alias("n"))
    return r.taxa.join(n, "taxon_id", "left").select("taxon_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("jon_22_carry_over", "SELECT n.observation_uuid, o.anomaly_score AS carried FROM obs n LEFT JOIN obs1 o ON n.observation_uuid = o.observation_uuid")
def _(r):
    return r.obs.select("observation_uuid").join(r.obs1.select("observation_uuid", F.col("anomaly_score").alias("carried")), "observation_uuid", "left")


# ---- aggregates
@query("agg_01_species_gate", f"SELECT o.taxon_id, CAST(count(*) AS BIGINT) AS n_obs FROM obs o JOIN taxa t USING (taxon_id) WHERE {IN_NA} AND quality_grade = 'research' AND rank_level = 10 GROUP BY o.taxon_id HAVING count(*) >= 2")
def _(r):
    return export.species_gate(r.obs, r.taxa, NA, 2)


@query("agg_02_global_threshold", "SELECT taxon_id, count(observation_uuid) AS n FROM obs GROUP BY taxon_id HAVING count(observation_uuid) >= 10")
def _(r):
    return r.obs.groupBy("taxon_id").agg(F.count("observation_uuid").alias("n")).where("n >= 10")


@query("agg_03_count_threshold", "SELECT taxon_id, count(*) AS n FROM obs1 GROUP BY taxon_id HAVING count(*) >= 5")
def _(r):
    return r.obs1.groupBy("taxon_id").agg(F.count("*").alias("n")).where("n >= 5")


@query("agg_04_rank_wipe", """
WITH j AS (SELECT observation_uuid, "L20_taxonID" AS g, "L40_taxonID" AS f FROM obs JOIN wide ON "taxonID" = taxon_id),
a AS (SELECT g, count(*) AS n FROM j GROUP BY g), b AS (SELECT f, count(*) AS n FROM j GROUP BY f)
SELECT observation_uuid, CASE WHEN a.n >= 120 THEN j.g END AS "L20_taxonID", CASE WHEN b.n >= 560 THEN j.f END AS "L40_taxonID" FROM j LEFT JOIN a ON a.g = j.g LEFT JOIN b ON b.f = j.f""")
def _(r):
    df = export.with_taxonomy(r.obs, r.wide)
    return export.wipe_rare(export.wipe_rare(df, 20, 120), 40, 560).select("observation_uuid", "L20_taxonID", "L40_taxonID")


@query("agg_05_three_distincts", "SELECT count(DISTINCT observation_uuid) AS a, count(DISTINCT taxon_id) AS b, count(DISTINCT observer_id) AS c FROM obs")
def _(r):
    return r.obs.agg(F.count_distinct("observation_uuid").alias("a"), F.count_distinct("taxon_id").alias("b"), F.count_distinct("observer_id").alias("c"))


SUMMARY = """
WITH j AS (SELECT o.*, photo_uuid FROM obs o JOIN photos USING (observation_uuid)), p AS (SELECT observation_uuid, count(*) AS n FROM j GROUP BY 1)
SELECT count(DISTINCT observation_uuid) AS n_obs, count(DISTINCT taxon_id) AS n_taxa, count(DISTINCT observer_id) AS n_observers, count(photo_uuid) AS n_photos, (SELECT count(*) FROM p WHERE n > 1) AS n_multi, (SELECT max(n) FROM p) AS max_photos,
  printf('%.2f', count(photo_uuid) / count(DISTINCT observation_uuid)) AS avg_photos FROM j"""


@query("agg_06_photo_stats", SUMMARY)
def _(r):
    return export.summary(r.obs.join(r.photos.select("observation_uuid", "photo_uuid"), "observation_uuid"))


@query("agg_07_conditional_distinct", "SELECT count(DISTINCT CASE WHEN quality_grade = 'research' THEN taxon_id END) AS rg, count(DISTINCT CASE WHEN quality_grade <> 'research' THEN taxon_id END) AS other FROM obs")
def _(r):
    return r.obs.agg(F.count_distinct(F.when(F.col("quality_grade") == "research", F.col("taxon_id"))).alias("rg"), F.count_distinct(F.when(F.col("quality_grade") != "research", F.col("taxon_id"))).alias("other"))


@query("agg_08_two_stages", "WITH t AS (SELECT taxon_id, count(*) AS n FROM obs GROUP BY 1) SELECT rank, CAST(sum(n) AS BIGINT) AS total, CAST(round(CAST(sum(n) AS DECIMAL(18,4)) * 100 / count(*)) AS BIGINT) AS mean_percent FROM t JOIN taxa USING (taxon_id) GROUP BY rank")
def _(r):
    t = r.obs.groupBy("taxon_id").agg(F.count("*").alias("n"))
    return t.join(r.taxa.select("taxon_id", "rank"), "taxon_id").groupBy("rank").agg(F.sum("n").alias("total"), F.round(F.sum("n").cast("decimal(18,4)") * 100 / F.count("*")).cast("bigint").alias("mean_percent"))


@query("agg_09_percent", "SELECT quality_grade, CAST(round(100000.0 * count(*) / (SELECT count(*) FROM obs)) AS BIGINT) AS milli_percent FROM obs GROUP BY quality_grade")
def _(r):
    total = r.obs.agg(F.count("*").alias("t"))
    return r.obs.groupBy("quality_grade").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("quality_grade", F.round(100000.0 * F.col("n") / F.col("t")).cast("bigint").alias("milli_percent"))


CLADE_LABEL = "CASE WHEN ancestry LIKE '1000/%' THEN 'africa' WHEN ancestry LIKE '1001/%' THEN 'america' WHEN ancestry = '' THEN 'root' ELSE 'other' END"


@query("agg_10_by_label", f"SELECT {CLADE_LABEL} AS clade, count(*) AS n FROM taxa GROUP BY 1")
def _(r):
    return r.taxa.groupBy(F.expr(CLADE_LABEL).alias("clade")).agg(F.count("*").alias("n"))


@query("agg_11_by_transition", "SELECT a.rank || ' -> ' || b.rank AS step, count(*) AS n FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.rank <> b.rank GROUP BY 1")
def _(r):
    return delta.changed(r.taxa, r.taxa2).where("old_rank <> new_rank").groupBy(F.concat("old_rank", F.lit(" -> "), "new_rank").alias("step")).agg(F.count("*").alias("n"))


@query("agg_12_date_range", "SELECT CAST(min(observed_on) AS VARCHAR) AS first, CAST(max(observed_on) AS VARCHAR) AS last FROM obs1")
def _(r):
    return r.obs1.agg(F.min("observed_on").cast("string").alias("first"), F.max("observed_on").cast("string").alias("last"))


@query("agg_13_sum_case", "SELECT rank, CAST(sum(CASE WHEN active THEN 1 ELSE 0 END) AS BIGINT) AS n FROM taxa GROUP BY rank")
def _(r):
    return r.taxa.groupBy("rank").agg(F.count_if("active").alias("n"))


@query("agg_14_top3_names", "SELECT rank, array_to_string(list_slice(list(name ORDER BY name), 1, 3), ', ') AS names FROM taxa WHERE name IS NOT NULL GROUP BY rank")
def _(r):
    """Three rows of a rank at most leave a partition (WindowGroupLimit), so no rank is gathered whole."""
    first = r.taxa.where("name is not null").withColumn("_k", F.row_number().over(Window.partitionBy("rank").orderBy("name"))).where("_k <= 3")
    return first.groupBy("rank").agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("names"))


@query("agg_15_distinct_sample", "SELECT observer_id, array_to_string(list_slice(list_sort(list(DISTINCT taxon_id)), 1, 3), ',') AS taxa FROM obs GROUP BY observer_id")
def _(r):
    first = r.obs.select("observer_id", "taxon_id").distinct().withColumn("_k", F.row_number().over(Window.partitionBy("observer_id").orderBy("taxon_id"))).where("_k <= 3")
    return first.groupBy("observer_id").agg(F.array_join(F.sort_array(F.collect_list("taxon_id")).cast("array<string>"), ",").alias("taxa"))


@query("agg_16_distinct", "SELECT DISTINCT observer_id, quality_grade FROM obs")
def _(r):
    return r.obs.select("observer_id", "quality_grade").distinct()


@query("agg_17_mode", "WITH c AS (SELECT observer_id, taxon_id, count(*) AS n FROM obs GROUP BY ALL) SELECT observer_id, first(taxon_id ORDER BY n DESC, taxon_id) AS common FROM c GROUP BY 1")
def _(r):
    return r.obs.groupBy("observer_id").agg(F.mode("taxon_id", True).alias("common"))


@query("agg_18_many_values", "SELECT observer_id, count(DISTINCT quality_grade) AS n FROM obs GROUP BY 1 HAVING count(DISTINCT quality_grade) > 1")
def _(r):
    return r.obs.groupBy("observer_id").agg(F.count_distinct("quality_grade").alias("n")).where("n > 1")


@query("agg_19_value_counts", "SELECT license, extension, count(*) AS n FROM photos GROUP BY ALL")
def _(r):
    return r.photos.groupBy("license", "extension").agg(F.count("*").alias("n"))


@query("agg_20_profile", "WITH p AS (SELECT observation_uuid, count(*) AS n FROM photos GROUP BY 1) SELECT CAST(max(n) AS BIGINT) AS most, CAST(floor(sum(n) * 1000 / count(*)) AS BIGINT) AS mean_milli, (SELECT min(photo_id) FROM photos) AS lo, (SELECT max(photo_id) FROM photos) AS hi FROM p")
def _(r):
    p = r.photos.groupBy("observation_uuid").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.floor(F.sum("n") * 1000 / F.count("*")).alias("mean_milli"))
    return p.crossJoin(r.photos.agg(F.min("photo_id").alias("lo"), F.max("photo_id").alias("hi")))


@query("agg_21_window_rate", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n, CAST(floor(coalesce(count(*) * 3600.0 / nullif(epoch(max(ts)) - epoch(min(ts)), 0), -1)) AS BIGINT) AS per_hour FROM events GROUP BY 1")
def _(r):
    e = r.table("events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    g = e.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("s"))
    return g.select("hour", "n", F.floor(F.coalesce(F.try_divide(F.col("n") * 3600.0, F.col("s")), F.lit(-1))).alias("per_hour"))


@query("agg_22_summary_by_kind", "SELECT source_kind, review_status, count(*) AS n, CAST(sum(confidence) AS BIGINT) AS total FROM ann GROUP BY ALL")
def _(r):
    return r.ann.groupBy("source_kind", "review_status").agg(F.count("*").alias("n"), F.sum("confidence").alias("total"))


@query("agg_23_coverage", 'SELECT count(*) AS n, count("L10_taxonID") AS species, count("L40_taxonID") AS orders FROM wide')
def _(r):
    return r.wide.agg(F.count("*").alias("n"), F.count("L10_taxonID").alias("species"), F.count("L40_taxonID").alias("orders"))


DIFF = """SELECT (SELECT count(*) FROM taxa WHERE taxon_id NOT IN (SELECT taxon_id FROM taxa2)) AS deprecated, (SELECT count(*) FROM taxa2 WHERE taxon_id NOT IN (SELECT taxon_id FROM taxa)) AS new,
count(*) FILTER (a.active <> b.active) AS activity, count(*) FILTER (a.name <> b.name) AS name, count(*) FILTER (a.ancestry <> b.ancestry OR a.rank <> b.rank OR a.rank_level <> b.rank_level) AS other FROM taxa a JOIN taxa2 b USING (taxon_id)"""


@query("agg_24_change_counters", DIFF)
def _(r):
    return delta.diff_counts(r.taxa, r.taxa2)


TRUST = "CASE WHEN coalesce(review_status, 'unreviewed') = 'rejected' OR coalesce(conflict_flag, FALSE) THEN 0 WHEN source_kind = 'human' AND coalesce(review_status, 'unreviewed') IN ('accepted', 'unreviewed') THEN 3 WHEN source_kind = 'model' AND review_status = 'accepted' AND coalesce(confidence, 0) >= 50 THEN 2 WHEN source_kind = 'imported_dataset' AND coalesce(review_status, 'unreviewed') IN ('accepted', 'unreviewed') THEN 2 ELSE 1 END"


@query("agg_25_trust_matrix", f"SELECT source_kind, review_status, {TRUST} AS trust_rank, count(*) AS n FROM ann GROUP BY ALL")
def _(r):
    from sylvaspark.operators import annotate

    return r.ann.groupBy("source_kind", "review_status", annotate.trust_rank(50).alias("trust_rank")).agg(F.count("*").alias("n"))


@query("agg_26_cube", "SELECT source_kind, label, count(*) AS n FROM ann GROUP BY CUBE (source_kind, label)")
def _(r):
    return r.ann.cube("source_kind", "label").agg(F.count("*").alias("n"))


# ---- windows, sorting
CAPPED = """
WITH j AS (SELECT o.observation_uuid, "L10_taxonID" AS sp, {region} AS in_region FROM obs o JOIN wide w ON w."taxonID" = o.taxon_id),
k AS (SELECT *, row_number() OVER (PARTITION BY sp ORDER BY in_region DESC, md5(observation_uuid), observation_uuid) AS rn FROM j WHERE sp IS NOT NULL)
SELECT observation_uuid, sp, CAST(rn AS BIGINT) AS rn FROM k WHERE rn <= 3 UNION ALL SELECT observation_uuid, NULL, NULL FROM j WHERE sp IS NULL"""


@query("win_01_species_cap", CAPPED.replace("{region}", STRICT_NA))
def _(r):
    df = export.with_taxonomy(r.obs.withColumn("in_region", geo.within(NA)), r.wide)
    return export.capped(df, 3).select("observation_uuid", F.col("L10_taxonID").alias("sp"), "rn")


@query("win_02_taxon_sample", "SELECT observation_uuid FROM obs QUALIFY row_number() OVER (PARTITION BY taxon_id ORDER BY md5(observation_uuid), observation_uuid) <= 4")
def _(r):
    w = Window.partitionBy("taxon_id").orderBy(F.md5("observation_uuid"), "observation_uuid")
    return r.obs.withColumn("rn", F.row_number().over(w)).where("rn <= 4").select("observation_uuid")


@query("win_03_photo_sample", "SELECT photo_id FROM photos JOIN obs USING (observation_uuid) WHERE quality_grade = 'research' QUALIFY row_number() OVER (PARTITION BY taxon_id ORDER BY md5(photo_uuid), photo_id) <= 2")
def _(r):
    w = Window.partitionBy("taxon_id").orderBy(F.md5("photo_uuid"), "photo_id")
    return r.obs.where("quality_grade = 'research'").join(r.photos, "observation_uuid").withColumn("rn", F.row_number().over(w)).where("rn <= 2").select("photo_id")


@query("win_04_best_annotation", f"SELECT annotation_id FROM (SELECT *, {TRUST} AS t FROM ann) QUALIFY row_number() OVER (PARTITION BY subject_id, label ORDER BY t DESC, confidence DESC NULLS LAST, annotation_id) = 1")
def _(r):
    from sylvaspark.operators import annotate

    return taxonomy.best_by_key(r.ann.withColumn("t", annotate.trust_rank(50)), ["subject_id", "label"], [F.desc("t"), F.desc_nulls_last("confidence"), F.asc("annotation_id")]).select("annotation_id")


@query("win_05_global_row_number", "SELECT annotation_id, row_number() OVER (ORDER BY created_at, annotation_id) AS rn FROM ann WHERE set_id = 1")
def _(r):
    return numbering.numbered(r.ann.where("set_id = 1").select("annotation_id", "created_at"), "created_at", "annotation_id").select("annotation_id", F.col("rn").cast("bigint").alias("rn"))


@query("srt_06_batches", "SELECT observation_uuid, CAST((row_number() OVER (ORDER BY observation_uuid) - 1) // 500 AS INTEGER) AS batch FROM obs")
def _(r):
    """Pages of 500 rows in the order of the key."""
    return numbering.batches(r.obs.select("observation_uuid"), "observation_uuid", 500).select("observation_uuid", "batch")


@query("win_06_first_per_key", "SELECT row_id FROM manifest WHERE sha256 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY coalesce(file_bytes, 0) DESC, row_id) = 1")
def _(r):
    return taxonomy.best_by_key(r.manifest.where("sha256 is not null"), ["sha256"], [F.desc(F.coalesce("file_bytes", F.lit(0))), F.asc("row_id")]).select("row_id")


@query("win_07_nearest_rank", "SELECT observer_id, taxon_id FROM (SELECT DISTINCT observer_id, taxon_id, rank_level FROM obs JOIN taxa USING (taxon_id)) QUALIFY row_number() OVER (PARTITION BY observer_id ORDER BY abs(rank_level - 20), taxon_id) = 1")
def _(r):
    d = r.obs.select("observer_id", "taxon_id").distinct().join(r.taxa.select("taxon_id", "rank_level"), "taxon_id")
    return d.groupBy("observer_id").agg(F.min_by("taxon_id", F.struct(F.abs(F.col("rank_level") - 20), "taxon_id")).alias("taxon_id"))


@query("win_08_best_homonym", FUZZY.replace("rn <= 5", "rn = 1"))
def _(r):
    return taxonomy.best_by_key(resolve.fuzzy_candidates(r.names, r.cat), ["taxon_id"], [F.desc("score"), F.asc("col_id")])


@query("srt_01_global_order", "SELECT observation_uuid, photo_id FROM (SELECT *, row_number() OVER (ORDER BY observation_uuid, position NULLS LAST, photo_id NULLS LAST, photo_uuid) AS k FROM photos) WHERE k <= 100")
def _(r):
    return export.ordered(r.photos).limit(100).select("observation_uuid", "photo_id")


@query("srt_02_priority_order", "SELECT taxon_id FROM taxa ORDER BY CASE rank WHEN 'genus' THEN 0 WHEN 'species' THEN 1 ELSE 2 END, taxon_id LIMIT 150")
def _(r):
    return r.taxa.orderBy(F.when(F.col("rank") == "genus", 0).when(F.col("rank") == "species", 1).otherwise(2), "taxon_id").limit(150).select("taxon_id")


@query("srt_03_top_n", "SELECT taxon_id, count(*) AS n FROM obs GROUP BY 1 ORDER BY n DESC, taxon_id LIMIT 10")
def _(r):
    return r.obs.groupBy("taxon_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "taxon_id").limit(10)


@query("srt_04_sample", "SELECT observation_uuid FROM obs ORDER BY md5(observation_uuid) LIMIT 25")
def _(r):
    return r.obs.orderBy(F.md5("observation_uuid")).limit(25).select("observation_uuid")


@query("srt_05_top5_candidates", FUZZY)
def _(r):
    return resolve.fuzzy_candidates(r.names, r.cat, 90, 5)


@query("srt_07_hash_sample", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)) LIMIT 50")
def _(r):
    return r.table("documents").orderBy(F.md5(F.col("doc_id").cast("string"))).limit(50).select("doc_id")


# ---- sets
@query("set_01_union_capped", CAPPED.replace("{region}", "TRUE").replace("rn <= 3", "rn <= 2"))
def _(r):
    return export.capped(export.with_taxonomy(r.obs.withColumn("in_region", F.lit(True)), r.wide), 2).select("observation_uuid", F.col("L10_taxonID").alias("sp"), "rn")


@query("set_02_self_and_ancestors", 'SELECT DISTINCT t AS taxon_id FROM (SELECT sp AS t FROM line UNION ALL SELECT anc FROM line) WHERE t IS NOT NULL')
def _(r):
    return r.wide.select(F.col("taxonID").alias("taxon_id")).union(taxonomy.slots_long(r.wide).select("anc")).distinct()


@query("set_03_union_distinct", "SELECT observer_id FROM obs WHERE observer_id % 2 = 0 UNION SELECT observer_id FROM photos WHERE observer_id % 3 = 0")
def _(r):
    return r.obs.where("observer_id % 2 = 0").select("observer_id").union(r.photos.where("observer_id % 3 = 0").select("observer_id")).distinct()


@query("set_04_union_changes", "SELECT taxon_id, 'name' AS kind FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.name <> b.name UNION SELECT taxon_id, 'rank' FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.rank <> b.rank")
def _(r):
    c = delta.changed(r.taxa, r.taxa2)
    return c.where("old_name <> new_name").select("taxon_id", F.lit("name").alias("kind")).union(c.where("old_rank <> new_rank").select("taxon_id", F.lit("rank"))).distinct()


@query("set_05_symmetric_difference", "(SELECT taxon_id, name FROM taxa EXCEPT SELECT taxon_id, name FROM taxa2) UNION ALL (SELECT taxon_id, name FROM taxa2 EXCEPT SELECT taxon_id, name FROM taxa)".replace("(SELECT taxon_id, name FROM taxa EXCEPT", "SELECT * FROM (SELECT taxon_id, name FROM taxa EXCEPT", 1))
def _(r):
    a, b = r.taxa.select("taxon_id", "name"), r.taxa2.select("taxon_id", "name")
    return a.subtract(b).unionByName(b.subtract(a))


@query("set_06_multi_root_union", 'SELECT DISTINCT sp AS taxon_id FROM line WHERE anc IN (2001, 2002)')
def _(r):
    long = taxonomy.slots_long(r.wide)
    return long.where("anc = 2001").select(F.col("taxonID").alias("taxon_id")).union(long.where("anc = 2002").select("taxonID")).distinct()


@query("set_07_table_counts", "SELECT 'ann' AS \"table\", count(*) AS n FROM ann UNION ALL SELECT 'edge', count(*) FROM edge")
def _(r):
    return sinks.counts(ann=r.ann, edge=r.edge)


@query("set_08_precedence_merge", "SELECT row_id, coalesce(CASE WHEN row_id % 5 = 0 THEN 'a' END, CASE WHEN row_id % 3 = 0 THEN 'b' END, CASE WHEN row_id % 2 = 0 THEN 'c' END) AS reason FROM manifest")
def _(r):
    pick = lambda n, v: F.when(F.col("row_id") % n == 0, v)
    return r.manifest.select("row_id", F.coalesce(pick(5, "a"), pick(3, "b"), pick(2, "c")).alias("reason"))


@query("set_09_intersect", "SELECT taxon_id, name FROM taxa INTERSECT SELECT taxon_id, name FROM taxa2")
def _(r):
    return r.taxa.select("taxon_id", "name").intersect(r.taxa2.select("taxon_id", "name"))


# ---- the whole export
SPEC = ExportSpec(region="NAfull", condition='"L70_taxonID" = 1001 OR "L70_taxonID" = 1002', min_obs=2, max_rn=3, mode="ALL_EXCLUDE_SPECIES_NON_RESEARCH", primary_only=True, scale=100)
EXPORT = f"""
WITH gate AS (SELECT o.taxon_id FROM obs o JOIN taxa t USING (taxon_id) WHERE {IN_NA} AND quality_grade = 'research' AND rank_level = 10 GROUP BY o.taxon_id HAVING count(*) >= 2),
sp AS (SELECT "taxonID" AS t FROM wide WHERE "taxonID" IN (SELECT taxon_id FROM gate) AND L70_taxonID IN (1001, 1002)),
clo AS (SELECT t FROM sp UNION SELECT a."taxonID" FROM line l JOIN sp ON sp.t = l.sp JOIN wide a ON a."taxonID" = l.anc WHERE a."rankLevel" < {{boundary}}),
o AS (SELECT obs.*, {{region}} AS in_region FROM obs WHERE taxon_id IN (SELECT t FROM clo) {{where}}),
j AS (SELECT o.*, w."L10_taxonID" AS sp, w."L20_taxonID" AS genus FROM o JOIN wide w ON w."taxonID" = o.taxon_id WHERE {{grade}}),
k AS (SELECT *, row_number() OVER (PARTITION BY sp ORDER BY in_region DESC, md5(observation_uuid), observation_uuid) AS rn FROM j),
c AS (SELECT * REPLACE (CASE WHEN sp IS NULL THEN NULL ELSE rn END AS rn) FROM k WHERE sp IS NULL OR rn <= 3)
SELECT observation_uuid, c.taxon_id, in_region, sp AS "L10_taxonID", genus AS "L20_taxonID", photo_id, p.position, CAST(rn AS BIGINT) AS rn FROM c JOIN photos p USING (observation_uuid) WHERE {{primary}}"""
EXPORT_COLS = ["observation_uuid", "taxon_id", "in_region", "L10_taxonID", "L20_taxonID", "photo_id", "position", "rn"]
_grade = "NOT (quality_grade <> 'research' AND w.\"L10_taxonID\" IS NOT NULL)"


def flagship(r):
    return run_export(r.obs, r.photos, r.taxa, SPEC, r.wide).select(EXPORT_COLS)


query("exp_01_capped_export", EXPORT.format(boundary=60, region="TRUE", where=f"AND {IN_NA}", grade=_grade, primary="p.position = 0"))(flagship)


@query("exp_02_out_of_region_multiphoto", EXPORT.format(boundary=70, region=STRICT_NA, where="", grade="TRUE", primary="TRUE"))
def _(r):
    from dataclasses import replace

    return run_export(r.obs, r.photos, r.taxa, replace(SPEC, out_of_region=True, minor_ranks=True, mode="ALL", primary_only=False), r.wide).select(EXPORT_COLS)


@query("snk_04_export_summary", EXPORT.format(boundary=60, region="TRUE", where=f"AND {IN_NA}", grade=_grade, primary="p.position = 0").replace("SELECT observation_uuid, c.taxon_id, in_region", "SELECT count(DISTINCT observation_uuid) AS n_obs, count(DISTINCT c.taxon_id) AS n_taxa, count(photo_id) AS n_photos FROM c JOIN photos p USING (observation_uuid) WHERE p.position = 0 --").split("--")[0])
def _(r):
    return export.summary(run_export(r.obs, r.photos, r.taxa, SPEC, r.wide)).select("n_obs", "n_taxa", "n_photos")
