"""Queries of scalar functions, hierarchy, raster, constraints, resolution, annotations, releases, older forms and streams over the roles."""

import pyarrow.fs as pafs
from pyspark.sql import Window
from pyspark.sql import functions as F

from sylvaspark import registry as data
from sylvaspark import schemas
from sylvaspark.functions import scalar
from sylvaspark.operators import annotate, delta, export, geo, legacy, numbering, pairs, quality, resolve, taxonomy
from sylvaspark.plans.q_relational import CLADE_LABEL, FUZZY, GRID, IMM, IN_EUR, IN_NA, NA, NORM, SIM, SPEC, TRUST
from sylvaspark.plans.registry import query, scratch
from sylvaspark.plans.scratch import kept
from sylvaspark.sources import files, sinks
from sylvaspark.streaming import jobs

EUR = data.region("EURfull").scaled(100)


# ---- scalar functions
@query("scf_01_md5", "SELECT observation_uuid, md5(observation_uuid) AS h FROM obs")
def _(r):
    return r.obs.select("observation_uuid", F.md5("observation_uuid").alias("h"))


@query("scf_02_seeded_order", "SELECT observation_uuid, TRUE AS in_range, TRUE AS same, TRUE AS other FROM obs")
def _(r):
    """Random numbers of a seed are in [0, 1), come again with the seed, and differ for another one."""
    d = r.obs.withColumns({"x": F.rand(3), "y": F.rand(3), "z": F.rand(4)})
    return d.select("observation_uuid", ((F.col("x") >= 0) & (F.col("x") < 1)).alias("in_range"), (F.col("x") == F.col("y")).alias("same"), (F.col("x") != F.col("z")).alias("other"))


@query("scf_03_null_functions", "SELECT annotation_id, coalesce(confidence, -1) AS a, nullif(label, 'click') AS b, greatest(confidence, 50) AS c FROM ann WHERE confidence IS NOT NULL")
def _(r):
    return r.ann.where("confidence is not null").select("annotation_id", F.coalesce("confidence", F.lit(-1)).alias("a"), F.nullif("label", F.lit("click")).alias("b"), F.greatest("confidence", F.lit(50)).alias("c"))


@query("scf_04_nested_case", "SELECT annotation_id, CASE WHEN source_kind = 'human' THEN 0 WHEN source_kind = 'model' THEN 1 WHEN source_kind = 'imported_dataset' THEN 2 ELSE 9 END AS p FROM ann")
def _(r):
    return r.ann.select("annotation_id", annotate.source_priority(F.lit("hybrid")).alias("p"))


@query("scf_05_casts", "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12,4)) * 100 AS BIGINT) AS cents, CAST(NULL AS INTEGER) AS nothing FROM part")
def _(r):
    return r.table("part").select("p_partkey", F.round(F.col("p_retailprice").cast("decimal(12,4)") * 100, 0).cast("bigint").alias("cents"), F.lit(None).cast("int").alias("nothing"))


@query("scf_06_concat_null", "SELECT taxon_id, name || ' (' || rank || ')' AS label FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", F.concat("name", F.lit(" ("), "rank", F.lit(")")).alias("label"))


@query("scf_07_path_array", "SELECT taxon_id, array_to_string(list_append(CASE WHEN ancestry = '' THEN [] ELSE string_split(ancestry, '/') END, CAST(taxon_id AS VARCHAR)), '>') AS path FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", F.array_join(F.array_append(taxonomy.path_ids(), F.col("taxon_id")).cast("array<string>"), ">").alias("path"))


@query("scf_08_level_suffix", "SELECT DISTINCT 'L' || replace(CASE WHEN rank_level = floor(rank_level) THEN CAST(CAST(rank_level AS INTEGER) AS VARCHAR) ELSE CAST(rank_level AS VARCHAR) END, '.', '_') AS slot FROM (SELECT rank_level FROM taxa UNION ALL SELECT 33.5)")
def _(r):
    slot = F.create_map(*[F.lit(x) for lv in schemas.LEVELS for x in (float(lv), schemas.slot(lv))])
    return r.taxa.select("rank_level").union(r.spark.createDataFrame([(33.5,)], "x double")).distinct().select(slot[F.col("rank_level")].alias("slot"))


@query("scf_09_format", "SELECT taxon_id, printf('%s:%d', rank, taxon_id) AS tag FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", F.format_string("%s:%d", "rank", "taxon_id").alias("tag"))


@query("scf_10_regex_capture", "SELECT taxon_id, CAST(nullif(regexp_extract(ancestry, '/([0-9]+)$', 1), '') AS INTEGER) AS parent FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", scalar.regex_int("ancestry", "/([0-9]+)$").alias("parent"))


@query("scf_11_patterns", "SELECT taxon_id, name LIKE 'NATION%' AS a, name ILIKE '%ouse%' AS b, regexp_matches(name, '[0-9]{3}') AS c FROM taxa WHERE name IS NOT NULL")
def _(r):
    return r.taxa.where("name is not null").select("taxon_id", F.col("name").like("NATION%").alias("a"), F.col("name").ilike("%ouse%").alias("b"), F.col("name").rlike("[0-9]{3}").alias("c"))


@query("scf_12_normalise", f"SELECT taxon_id, {NORM} AS n FROM names")
def _(r):
    return r.names.select("taxon_id", scalar.normalise_name("name").alias("n"))


@query("scf_13_round_abs", "SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(12,2))) AS BIGINT) AS whole, abs(p_size - 25) AS far FROM part")
def _(r):
    return r.table("part").select("p_partkey", F.round(F.col("p_retailprice").cast("decimal(12,2)")).cast("bigint").alias("whole"), F.abs(F.col("p_size") - 25).alias("far"))


@query("scf_14_epoch_interval", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts + INTERVAL 30 MINUTE)) AS BIGINT) AS later FROM events")
def _(r):
    ts = F.col("ts").cast("timestamp")
    return r.table("events").select("event_id", F.unix_seconds(ts).alias("s"), F.unix_seconds(ts + F.expr("interval 30 minutes")).alias("later"))


@query("scf_15_array_functions", "SELECT set_id, count(*) AS n FROM ann WHERE list_contains([1, 3], set_id) AND len([1, 3]) = 2 GROUP BY set_id")
def _(r):
    ids = F.array(F.lit(1), F.lit(3))
    return r.ann.where(F.array_contains(ids, F.col("set_id")) & (F.size(ids) == 2)).groupBy("set_id").agg(F.count("*").alias("n"))


@query("scf_16_unique_ids", "SELECT count(*) AS n, count(*) AS distinct_ids, count(*) AS version_4 FROM obs")
def _(r):
    """Random ids of version 4, one for each observation."""
    return r.obs.withColumn("u", F.uuid()).agg(F.count("*").alias("n"), F.count_distinct("u").alias("distinct_ids"), F.count_if(F.substring("u", 15, 1) == "4").alias("version_4"))


U5 = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || CAST(name AS BLOB))"
UUID5_SQL = f"""SELECT taxon_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS u FROM (SELECT taxon_id, {U5} AS h FROM taxa WHERE name IS NOT NULL)"""


@query("scf_17_uuid5", UUID5_SQL)
def _(r):
    return r.taxa.where("name is not null").select("taxon_id", scalar.uuid5("name").alias("u"))


@query("scf_18_sha256", "SELECT doc_id, sha256(text) AS h FROM documents")
def _(r):
    return r.table("documents").select("doc_id", F.sha2("text", 256).alias("h"))


@query("scf_20_hex_to_int64", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(CASE WHEN v >= 9223372036854775808 THEN v - 18446744073709551616 ELSE v END AS VARCHAR) END AS x FROM (SELECT doc_id, CAST('0x' || substr(md5(text), 1, 8) AS HUGEINT) * 4294967296 + CAST('0x' || substr(md5(text), 9, 8) AS HUGEINT) AS v FROM documents)")
def _(r):
    h = F.substring(F.md5("text"), 1, 16)
    bad = F.concat(h, F.lit("00"))
    return r.table("documents").select("doc_id", scalar.hex_to_int64(F.when(F.col("doc_id") % 3 == 0, bad).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("0x"), h)).otherwise(h)).cast("string").alias("x"))


@query("scf_21_filename_ids", r"SELECT row_id, CAST(regexp_extract(filename, '^Genus[0-9]+_species_([0-9]+)', 1) AS BIGINT) AS id, CAST(NULL AS BIGINT) AS suffix, 'extracted_number' AS kind FROM manifest")
def _(r):
    a, b, c = scalar.filename_ids("filename")
    return r.manifest.select("row_id", a.alias("id"), b.alias("suffix"), c.alias("kind"))


@query("scf_22_rank_by_words", "SELECT p_partkey, CASE len(string_split(replace(p_name, ' ', '_'), '_')) WHEN 1 THEN 'genus' WHEN 2 THEN 'species' ELSE 'subspecies' END AS guess, CASE len(string_split(replace(p_name, ' ', '_'), '_')) WHEN 1 THEN 'L20' WHEN 2 THEN 'L10' WHEN 3 THEN 'L5' ELSE 'Unknown' END AS code FROM part")
def _(r):
    u = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    return r.table("part").select("p_partkey", scalar.rank_guess(scalar.spaced(u)).alias("guess"), scalar.rank_code_guess(u).alias("code"))


@query("scf_23_flat_name", "SELECT row_id, sha256 || lower(regexp_extract(filename, '(\\.[^.]*)$', 1)) AS flat FROM manifest")
def _(r):
    return r.manifest.select("row_id", scalar.flat_name("sha256", "filename").alias("flat"))


@query("scf_24_safe_casts", "SELECT page_id, TRY_CAST(trim(regexp_extract(url, '/([^/?#]*)[?#]?[^/]*$', 1)) AS BIGINT) AS n FROM pages")
def _(r):
    return r.table("pages").select("page_id", scalar.safe_int(F.regexp_extract("url", "/([^/?#]*)[?#]?[^/]*$", 1)).alias("n"))


@query("scf_25_sidecar", "SELECT row_id, '{\"row_id\":' || row_id || ',\"filename\":\"' || filename || '\"}' AS sidecar FROM manifest")
def _(r):
    return r.manifest.select("row_id", scalar.media_sidecar("row_id", "filename").alias("sidecar"))


@query("scf_26_similarity", f"WITH a AS (SELECT taxon_id, {NORM} AS a FROM names), b AS (SELECT col_id, {NORM} AS b FROM cat) SELECT taxon_id, col_id, CAST(floor(1000 * (100.0::DOUBLE - 100.0::DOUBLE * levenshtein(a, b) / greatest(length(a), length(b)))) AS BIGINT) AS milli FROM a JOIN b ON col_id IN ('C' || taxon_id, 'C' || (taxon_id + 1), 'C' || (taxon_id * 3 + 1))")
def _(r):
    """Each name against three of the catalogue: its own, its neighbour's and a far one's."""
    a = r.names.select("taxon_id", scalar.normalise_name("name").alias("a"))
    a = a.withColumn("col_id", F.explode(F.array_distinct(F.transform(F.array(F.col("taxon_id"), F.col("taxon_id") + 1, F.col("taxon_id") * 3 + 1), lambda x: F.concat(F.lit("C"), x.cast("string"))))))
    b = r.cat.select("col_id", scalar.normalise_name("name").alias("b"))
    return a.join(b, "col_id").select("taxon_id", "col_id", F.floor(1000 * scalar.similarity("a", "b")).alias("milli"))


@query("scf_27_major_floor", "SELECT DISTINCT rank_level AS level, CASE WHEN floor(rank_level / 10) * 10 = rank_level THEN rank_level - 10 ELSE floor(rank_level / 10) * 10 END AS major FROM taxa")
def _(r):
    return r.taxa.select(F.col("rank_level").alias("level"), scalar.major_floor("rank_level").alias("major")).distinct()


@query("scf_28_rank_codes", "SELECT taxon_id, CASE rank WHEN 'species' THEN 'L10' WHEN 'genus' THEN 'L20' WHEN 'order' THEN 'L40' WHEN 'kingdom' THEN 'L70' WHEN 'subspecies' THEN 'L5' END AS code, rank AS back FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", scalar.rank_code("rank").alias("code"), scalar.rank_name(scalar.rank_code("rank")).alias("back"))


@query("scf_29_zero_based", "SELECT photo_id, 'photo_' || position AS p FROM photos")
def _(r):
    return r.photos.select("photo_id", scalar.zero_based(F.concat(F.lit("photo_"), F.col("position") + 1)).alias("p"))


@query("scf_30_filename_parts", "SELECT p_partkey, replace(p_name, ' ', '_') AS x, array_to_string(list_slice(string_split(f, '_'), 1, len(string_split(f, '_')) - 2), ' ') AS name, CASE WHEN len(string_split(f, '_')) >= 5 THEN string_split(f, '_')[len(string_split(f, '_')) - 1] END AS position FROM (SELECT *, replace(p_name, ' ', '_') || '_' || p_type || CASE WHEN p_size % 2 = 0 THEN '_a' ELSE '' END || '_' || p_size AS f FROM part)")
def _(r):
    x = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    f = F.concat(x, F.lit("_"), "p_type", F.when(F.col("p_size") % 2 == 0, "_a").otherwise(""), F.lit("_"), F.col("p_size").cast("string"))
    name, position = scalar.filename_parts(f)
    return r.table("part").select("p_partkey", x.alias("x"), name.alias("name"), position.alias("position"))


@query("scf_31_json_field", "SELECT annotation_id, CAST(json_extract(sidecar, '$.k') AS INTEGER) AS k FROM ann")
def _(r):
    return r.ann.select("annotation_id", F.get_json_object("sidecar", "$.k").cast("int").alias("k"))


# ---- hierarchy
W5 = '"taxonID", "rankLevel", name, L5_taxonID, L10_taxonID, L20_taxonID, L40_taxonID, L70_taxonID, L5_name, L10_name, L20_name, L40_name, L70_name'
W5C = ["taxonID", "rankLevel", "name", *[f"{s}_{x}" for x in ("taxonID", "name") for s in ("L5", "L10", "L20", "L40", "L70")]]


@query("hie_01_expand", f"SELECT {W5} FROM wide")
def _(r):
    return taxonomy.expand(r.taxa).select(W5C)


_SLOTS = ("L5", "L10", "L20", "L40", "L70")


@query("hie_02_wide_schema", " UNION ALL ".join(f"SELECT '{s}' AS slot, count({s}_taxonID) AS ids, count({s}_name) AS names FROM wide" if s in _SLOTS else f"SELECT '{s}', CAST(0 AS BIGINT), CAST(0 AS BIGINT)" for s in sorted([schemas.slot(x) for x in schemas.LEVELS], key=lambda s: s not in _SLOTS)))
def _(r):
    """How many taxa have an id and a name in each of the generated columns of the 30 ranks."""
    each = [F.struct(F.lit(s).alias("slot"), F.count(f"{s}_taxonID").alias("ids"), F.count(f"{s}_name").alias("names")) for s in [schemas.slot(x) for x in schemas.LEVELS]]
    return r.wide.agg(F.array(*each).alias("a")).select(F.inline("a"))


@query("hie_03_immediate_ancestor", f'SELECT "taxonID", {IMM} AS "immediateAncestor_taxonID" FROM wide')
def _(r):
    return taxonomy.with_immediate_ancestors(r.wide).select("taxonID", "immediateAncestor_taxonID")


@query("hie_04_immediate_major", f'SELECT "taxonID", {IMM} AS "immediateMajorAncestor_taxonID", CASE {IMM} WHEN L10_taxonID THEN 10.0::DOUBLE WHEN L20_taxonID THEN 20.0 WHEN L40_taxonID THEN 40.0 WHEN L70_taxonID THEN 70.0 END AS "immediateMajorAncestor_rankLevel" FROM wide')
def _(r):
    return taxonomy.with_immediate_ancestors(r.wide).select("taxonID", "immediateMajorAncestor_taxonID", "immediateMajorAncestor_rankLevel")


GATE = f"SELECT o.taxon_id FROM obs o JOIN taxa t USING (taxon_id) WHERE {IN_NA} AND quality_grade = 'research' AND rank_level = 10 GROUP BY o.taxon_id HAVING count(*) >= 2"


def _gate(r):
    return export.species_gate(r.obs, r.taxa, NA, 2)


@query("hie_05_species_of_root", f'SELECT "taxonID" AS taxon_id FROM wide WHERE "taxonID" IN ({GATE}) AND L70_taxonID = 1001')
def _(r):
    return taxonomy.species_of_root(_gate(r), r.wide, 70, 1001)


CLOSURE = f'WITH sp AS (SELECT "taxonID" AS t FROM wide WHERE "taxonID" IN ({GATE}) AND L70_taxonID = 1001) SELECT t AS taxon_id FROM sp UNION SELECT a."taxonID" FROM line JOIN sp ON sp.t = line.sp JOIN wide a ON a."taxonID" = line.anc WHERE a."rankLevel" < {{b}}'


@query("hie_06_closure", CLOSURE.replace("{b}", "70"))
def _(r):
    return taxonomy.closure(taxonomy.species_of_root(_gate(r), r.wide, 70, 1001), r.wide, data.boundary(70, True))


@query("hie_07_boundary_major", CLOSURE.replace("{b}", "40"))
def _(r):
    return taxonomy.closure(taxonomy.species_of_root(_gate(r), r.wide, 70, 1001), r.wide, data.boundary(50, False))


@query("hie_08_independence", 'SELECT CAST(2001 AS INTEGER) AS root, anc AS taxon_id FROM line WHERE sp = 2001 AND anc IN (SELECT "taxonID" FROM wide WHERE "rankLevel" <= 40) UNION SELECT 2002, anc FROM line WHERE sp = 2002 AND anc IN (SELECT "taxonID" FROM wide WHERE "rankLevel" <= 40)')
def _(r):
    return taxonomy.root_sets(r.wide, [(40.0, 2001), (40.0, 2002)])


@query("hie_09_observation_closure", f"SELECT observation_uuid, coalesce(longitude > {NA.west} AND longitude < {NA.east} AND latitude > {NA.south} AND latitude < {NA.north}, FALSE) AS in_region FROM obs WHERE taxon_id IN ({GATE})")
def _(r):
    return export.observations_of(r.obs, _gate(r).select("taxon_id"), NA, True).select("observation_uuid", "in_region")


@query("hie_10_stage_key", "SELECT min_obs, min_obs = 30 AS same, min_obs <> 30 AS differs FROM (SELECT 10 + 10 * r_regionkey AS min_obs FROM region)")
def _(r):
    """The key of a stage with each of several thresholds, against the key of one with 30: parameters decide, and equal ones agree."""
    from dataclasses import replace

    base = replace(SPEC, min_obs=30).key()
    rows = [(k, replace(SPEC, min_obs=k).key() == base, replace(SPEC, min_obs=k).key() != base) for k in sorted(10 + 10 * x.r_regionkey for x in r.table("region").select("r_regionkey").collect())]
    return r.spark.createDataFrame(rows, "min_obs int, same boolean, differs boolean")


@query("hie_11_common_ancestor", 'WITH s AS (SELECT sp, anc, rank_level FROM line JOIN taxa ON taxon_id = anc), p AS (SELECT a."taxonID" AS a, b."taxonID" AS b FROM wide a JOIN wide b ON b."taxonID" = a."taxonID" + 1 WHERE a."rankLevel" = 10 AND b."rankLevel" = 10) SELECT a, b, arg_min(m.anc, m.rank_level) AS lca, min(m.rank_level) AS lca_level FROM p JOIN s m ON m.sp = a JOIN s n ON n.sp = b AND n.anc = m.anc GROUP BY a, b')
def _(r):
    a, b = r.wide.where("rankLevel = 10").select(F.col("taxonID").alias("a")), r.wide.where("rankLevel = 10").select(F.col("taxonID").alias("b"))
    return taxonomy.common_ancestor(r.wide, a.join(b, F.col("b") == F.col("a") + 1))


@query("hie_12_ancestry_record", "SELECT t.taxon_id, string_agg(CASE a.rank WHEN 'kingdom' THEN 'L70' WHEN 'order' THEN 'L40' WHEN 'genus' THEN 'L20' WHEN 'species' THEN 'L10' ELSE 'L5' END || '=' || a.name, ';' ORDER BY a.rank_level DESC) AS record FROM (SELECT taxon_id, unnest(list_append(CASE WHEN ancestry = '' THEN [] ELSE string_split(ancestry, '/') END, CAST(taxon_id AS VARCHAR))) AS anc FROM taxa) t JOIN taxa a ON CAST(a.taxon_id AS VARCHAR) = t.anc WHERE a.name IS NOT NULL GROUP BY t.taxon_id")
def _(r):
    entry = F.transform(F.array(*[F.lit(s) for s in ("L70", "L40", "L20", "L10", "L5")]), lambda s: F.concat(s, F.lit("="), F.try_element_at("ancestors", s)))
    return taxonomy.ancestry_record(r.taxa).select("taxon_id", F.array_join(F.array_compact(entry), ";").alias("record"))


NAMES = "SELECT taxon_id, min(cn) AS common_name FROM xwalk JOIN (SELECT col_id, first(name ORDER BY CASE WHEN preferred THEN 0 ELSE 1 END, name) AS cn FROM vern WHERE language = 'eng' AND (preferred OR preferred IS NULL) GROUP BY col_id) USING (col_id) GROUP BY taxon_id"


@query("hie_13_common_names", f'WITH n AS ({NAMES}) SELECT "taxonID", a.common_name AS "commonName", b.common_name AS "L20_commonName", c.common_name AS "L40_commonName" FROM wide LEFT JOIN n a ON a.taxon_id = "taxonID" LEFT JOIN n b ON b.taxon_id = L20_taxonID LEFT JOIN n c ON c.taxon_id = L40_taxonID')
def _(r):
    return taxonomy.with_common_names(r.wide, taxonomy.preferred_names(r.vern, r.xwalk)).select("taxonID", "commonName", "L20_commonName", "L40_commonName")


@query("hie_14_clear_common_names", 'SELECT "taxonID", CAST(NULL AS VARCHAR) AS "commonName" FROM wide')
def _(r):
    return taxonomy.without_common_names(r.wide.withColumn("commonName", F.lit("x"))).select("taxonID", "commonName")


# ---- geometry and raster
@query("geo_01_points", "SELECT observation_uuid, CAST(longitude AS DOUBLE) AS lon, CAST(latitude AS DOUBLE) AS lat FROM obs")
def _(r):
    return geo.with_point(r.obs).select("observation_uuid", "lon", "lat")


@query("geo_02_envelope", f"SELECT observation_uuid, {IN_EUR} AS touches, longitude > {EUR.west} AND longitude < {EUR.east} AND latitude > {EUR.south} AND latitude < {EUR.north} AS inside FROM obs")
def _(r):
    return r.obs.select("observation_uuid", geo.overlaps(EUR).alias("touches"), geo.within(EUR).alias("inside"))


def _tiles(r):
    return r.cells.selectExpr("iy * 36 + ix tile_id", "cast(ix * 1000 - 18000 as double) ulx", "cast(iy * 1000 - 8000 as double) uly", "1000D px_w", "1000D px_h", "1 cols", "1 rows", "-9999F nodata", "array(cast(elevation as float)) values")


@query("geo_03_raster_sample", "SELECT observation_uuid, CASE WHEN elevation = -9999 THEN NULL ELSE CAST(elevation AS DOUBLE) END AS elevation FROM obs LEFT JOIN cells ON ix = CAST(floor((longitude + 18000) / 1000.0) AS INTEGER) AND iy = CAST(ceil((latitude + 9000) / 1000.0) AS INTEGER) - 1")
def _(r):
    p = r.obs.selectExpr("observation_uuid", "cast(longitude as double) lon", "cast(latitude as double) - 0.5 lat")
    return geo.sample_tiles(p, _tiles(r), 3000.0, "observation_uuid").select("observation_uuid", "elevation")


@query("geo_04_point_lookup", "SELECT elevation FROM cells WHERE ix = 3 AND iy = 2")
def _(r):
    p = r.spark.createDataFrame([(-14500, -6500)], "longitude int, latitude int")
    return geo.sample_grid(p, r.cells, -18000, -9000, 1000).select("elevation")


NEEDS = "SELECT observation_uuid FROM obs WHERE obs_key % 3 <> 0"


@query("geo_05_fill_split", f"WITH g AS ({GRID}) SELECT observation_uuid, elevation, CASE WHEN elevation IS NULL THEN 'no_raster_value' END AS reason FROM g WHERE observation_uuid IN ({NEEDS})")
def _(r):
    points = r.obs.withColumn("elevation", F.when(F.col("obs_key") % 3 == 0, 1))
    sampled = geo.sample_grid(r.obs, r.cells, -18000, -9000, 1000)
    filled, excluded = geo.fill(points, sampled, "observation_uuid")
    return filled.withColumn("reason", F.lit(None).cast("string")).unionByName(excluded).select("observation_uuid", "elevation", "reason")


@query("geo_06_batch_report", "WITH b AS (SELECT (row_number() OVER (ORDER BY observation_uuid) - 1) // 1000 AS batch FROM obs) SELECT CAST(batch AS INTEGER) AS batch, count(*) AS n FROM b GROUP BY batch")
def _(r):
    return numbering.batches(r.obs.select("observation_uuid"), "observation_uuid", 1000).groupBy("batch").agg(F.count("*").alias("n"))


@query("geo_07_coverage", f"WITH g AS ({GRID}) SELECT count(*) AS total, count(*) FILTER (elevation IS NULL) AS no_elevation, count(*) FILTER (elevation IS NULL) AS fillable, CAST(0 AS BIGINT) AS unplaced FROM g")
def _(r):
    return geo.coverage(geo.sample_grid(r.obs, r.cells, -18000, -9000, 1000))


@query("geo_08_run_state", """
WITH b AS (SELECT annotation_id // 1000 AS run, annotation_id // 100 AS batch, count(*) FILTER (label = 'click') AS filled, 9 - annotation_id // 100 % 10 AS remaining, bool_or(annotation_id % 10007 = 9907) AS error FROM ann GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY batch DESC) AS k FROM b)
SELECT run, CASE WHEN bool_or(error) FILTER (k = 1) THEN 'failed' WHEN min(remaining) FILTER (k = 1) = 0 THEN 'completed' WHEN sum(filled) FILTER (k <= 3) = 0 AND count(*) >= 3 THEN 'stopped' ELSE 'running' END AS state,
  CAST(sum(filled) AS BIGINT) AS done, min(remaining) FILTER (k = 1) AS left FROM k GROUP BY run""")
def _(r):
    """Runs of ten batches of a hundred rows each; the last run breaks off where the table ends."""
    run, batch = F.expr("annotation_id div 1000").alias("run"), F.expr("annotation_id div 100").alias("batch")
    b = r.ann.groupBy(run, batch).agg(F.count_if(F.col("label") == "click").alias("filled"), F.bool_or(F.col("annotation_id") % 10007 == 9907).alias("error"))
    return geo.run_states(b.withColumn("remaining", 9 - F.col("batch") % 10))


@query("geo_09_payload_rules", "SELECT event_id, 'bbox_order' AS violations FROM events WHERE event_id % 4 = 0 UNION ALL SELECT event_id, 'point_complete' FROM events WHERE event_id % 4 = 1")
def _(r):
    d = r.table("events").selectExpr("event_id", "case event_id % 4 when 0 then 'bbox' when 1 then 'point' else 'whole' end geometry_kind", "if(event_id % 4 = 0, 0.5D, null) bbox_x_min", "if(event_id % 4 = 0, 0.1D, null) bbox_y_min", "if(event_id % 4 = 0, 0.4D, null) bbox_x_max", "if(event_id % 4 = 0, 0.9D, null) bbox_y_max", "if(event_id % 4 = 1, 0.2D, null) point_x", "cast(null as double) point_y")
    return quality.violations(d, geo.payload_rules()).select("event_id", F.array_join("violations", ",").alias("violations"))


# ---- changes of tables, constraints
@query("dml_01_provenance", "SELECT observation_uuid, 'open data' AS origin, 'v0' AS version, 'r1' AS release FROM obs")
def _(r):
    return r.obs.withColumns({"origin": F.lit("open data"), "version": F.lit("v0"), "release": F.lit("r1")}).select("observation_uuid", "origin", "version", "release")


@query("dml_02_default_columns", "SELECT photo_id, 'r2' AS release FROM photos")
def _(r):
    return r.photos.select("photo_id", F.lit("r2").alias("release"))


@query("dml_03_add_release", "SELECT observer_id, count(*) AS n, 'r0' AS release FROM obs GROUP BY observer_id")
def _(r):
    return r.obs.groupBy("observer_id").agg(F.count("*").alias("n")).withColumn("release", F.lit("r0"))


@query("dml_05_insert_only", "SELECT observation_uuid, taxon_id, NULL AS release FROM obs1 UNION ALL SELECT observation_uuid, taxon_id, 'r2' FROM obs WHERE observation_uuid NOT IN (SELECT observation_uuid FROM obs1)")
def _(r):
    cols = ["observation_uuid", "taxon_id"]
    return delta.insert_absent(r.obs1.select(cols), r.obs.select(cols), "observation_uuid", release="r2")


RULES = """
SELECT a.taxon_id AS old_id, a.taxon_id AS new_id, 'RANK_CHANGE_ONLY' AS kind, 'HIGH' AS confidence FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.name = b.name AND a.rank_level <> b.rank_level AND b.active
UNION ALL SELECT a.taxon_id, TRY_CAST(string_split(a.ancestry, '/')[-1] AS INTEGER), 'SUBSPECIES_TO_SPECIES', CASE WHEN c.active THEN 'HIGH' ELSE 'LOW' END FROM taxa a JOIN taxa2 b USING (taxon_id) LEFT JOIN taxa2 c ON c.taxon_id = TRY_CAST(string_split(a.ancestry, '/')[-1] AS INTEGER)
WHERE a.rank = 'subspecies' AND a.active AND NOT b.active"""
REMAP = f"SELECT o.observation_uuid, coalesce(r.new_id, o.taxon_id) AS taxon_id FROM obs o LEFT JOIN ({RULES}) r ON r.old_id = o.taxon_id AND r.confidence = 'HIGH' AND r.old_id <> r.new_id"


@query("dml_06_remap", REMAP)
def _(r):
    return delta.remap(r.obs, delta.remap_rules(r.taxa, r.taxa2)).select("observation_uuid", "taxon_id")


def _rules():
    return {"confidence": F.col("confidence").between(5, 95), "label": F.col("label").isin("click", "view", "error", "signup"), "state": F.col("lifecycle_state") == "active"}


@query("dml_07_checks", "SELECT annotation_id, concat_ws(',', CASE WHEN NOT confidence BETWEEN 5 AND 95 THEN 'confidence' END, CASE WHEN label = 'purchase' THEN 'label' END, CASE WHEN lifecycle_state <> 'active' THEN 'state' END) AS violations FROM ann WHERE coalesce(NOT confidence BETWEEN 5 AND 95, FALSE) OR label = 'purchase' OR lifecycle_state <> 'active'")
def _(r):
    return quality.violations(r.ann, _rules()).select("annotation_id", F.array_join("violations", ",").alias("violations"))


@query("dml_08_unique", "SELECT sha256, count(*) AS n FROM manifest WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1")
def _(r):
    return quality.duplicates(r.manifest, ["sha256"])


@query("dml_09_orphans", "SELECT observation_uuid, taxon_id FROM obs WHERE taxon_id NOT IN (SELECT taxon_id FROM taxa2)")
def _(r):
    return quality.orphans(r.obs, "taxon_id", r.taxa2, "taxon_id").select("observation_uuid", "taxon_id")


@query("dml_10_provenance_exists", "SELECT annotation_id FROM ann WHERE annotation_id NOT IN (SELECT event_id FROM events WHERE event_id % 7 <> 0)")
def _(r):
    return quality.childless(r.ann, "annotation_id", r.table("events").where("event_id % 7 <> 0"), "event_id").select("annotation_id")


@query("dml_11_superseded_state", "SELECT annotation_id, CASE WHEN annotation_id IN (SELECT superseded_annotation_id FROM edge) THEN 'superseded' ELSE lifecycle_state END AS lifecycle_state FROM ann")
def _(r):
    return annotate.lifecycle(r.ann, r.edge).select("annotation_id", "lifecycle_state")


@query("dml_15_layout", "SELECT count(*) AS n FROM obs WHERE longitude BETWEEN 0 AND 999")
def _(r):
    path = scratch(r.spark)
    r.obs.withColumn("gx", F.floor(F.col("longitude") / 1000)).repartition("gx").write.partitionBy("gx").parquet(path)
    return r.spark.read.parquet(path).where("gx = 0 and longitude between 0 and 999").agg(F.count("*").alias("n"))


@query("dml_17_rebuild", "SELECT taxon_id FROM taxa WHERE rank = 'order'")
def _(r):
    path = scratch(r.spark)
    r.taxa.where("rank = 'genus'").write.parquet(path)
    r.taxa.where("rank = 'order'").write.mode("overwrite").parquet(path)
    return r.spark.read.parquet(path).select("taxon_id")


# ---- resolution and duplicates
EXACT = f"""
WITH a AS (SELECT taxon_id, {NORM} AS n, lower(rank) AS r FROM names), b AS (SELECT col_id, {NORM} AS n, lower(rank) AS r, status FROM cat),
x AS (SELECT taxon_id, col_id, status, row_number() OVER (PARTITION BY taxon_id ORDER BY status, col_id) AS k FROM a JOIN b ON a.n = b.n AND a.r IS NOT DISTINCT FROM b.r),
y AS (SELECT taxon_id, col_id, status, row_number() OVER (PARTITION BY taxon_id ORDER BY status, col_id) AS k FROM a JOIN b ON a.n = b.n WHERE taxon_id NOT IN (SELECT taxon_id FROM x))
SELECT taxon_id, col_id, 'exact_name_rank_' || CASE status WHEN 'accepted' THEN 'accepted' ELSE 'other_status' END AS match_type, 1.0::DOUBLE AS match_score FROM x WHERE k = 1
UNION ALL SELECT taxon_id, col_id, 'exact_name_only_' || CASE status WHEN 'accepted' THEN 'accepted' ELSE 'other_status' END, 0.95 FROM y WHERE k = 1"""


@query("ent_01_exact_name_rank", f"SELECT * FROM ({EXACT}) WHERE match_score = 1.0")
def _(r):
    return resolve.exact_matches(r.names, r.cat).where("match_score = 1.0")


@query("ent_02_exact_name_only", f"SELECT * FROM ({EXACT}) WHERE match_score < 1.0")
def _(r):
    return resolve.exact_matches(r.names, r.cat).where("match_score < 1.0")


@query("ent_03_fuzzy", FUZZY.replace("FROM cat)", "FROM cat WHERE status = 'accepted')"))
def _(r):
    return resolve.fuzzy_candidates(r.names, r.cat.where("status = 'accepted'"))


def _lineages(r):
    own = r.names.select("taxon_id", F.when(F.col("taxon_id") % 5 != 0, F.split("name", " ")[0]).alias("genus"), F.when(F.col("taxon_id") % 5 != 0, F.lit("fam")).alias("family"), *[F.lit(None).cast("string").alias(c) for c in ("order", "class", "phylum")])
    theirs = r.cat.select("col_id", F.lower(F.split("name", " ")[0]).alias("genus"), F.when(F.length("col_id") % 2 == 0, "FAM").otherwise("other").alias("family"), *[F.lit(None).cast("string").alias(c) for c in ("order", "class", "phylum")])
    return own, theirs


HOMONYM = f"""
WITH f AS ({FUZZY}), g AS (SELECT f.*, count(*) OVER (PARTITION BY taxon_id) AS n, taxon_id % 5 <> 0 AS known,
  CASE WHEN taxon_id % 5 <> 0 AND lower(string_split(x.name, ' ')[1]) = lower(string_split(c.name, ' ')[1]) THEN 2 ELSE 0 END + CASE WHEN taxon_id % 5 <> 0 AND length(col_id) % 2 = 0 THEN 1 ELSE 0 END AS p
  FROM f JOIN names x USING (taxon_id) JOIN cat c USING (col_id)),
h AS (SELECT *, row_number() OVER (PARTITION BY taxon_id ORDER BY p DESC, score DESC, col_id) AS k FROM g)
SELECT taxon_id, col_id, CASE WHEN n = 1 THEN 'fuzzy_name_single_match' WHEN NOT known THEN 'fuzzy_name_highest_score' WHEN p > 0 THEN 'fuzzy_name_with_ancestors' ELSE 'fuzzy_name_no_ancestors' END AS match_type, score / 100 AS match_score FROM h WHERE k = 1"""


@query("ent_04_homonyms", HOMONYM)
def _(r):
    return resolve.resolve_homonyms(resolve.fuzzy_candidates(r.names, r.cat), *_lineages(r))


_FALLBACK = f"""
WITH a AS (SELECT taxon_id, {NORM} AS a FROM names WHERE taxon_id NOT IN (SELECT taxon_id FROM ({EXACT}))), b AS (SELECT col_id, {NORM} AS b, status = 'accepted' AS ok FROM cat),
p AS (SELECT taxon_id, col_id, ok, {SIM} AS score FROM a, b WHERE a <> '' AND b <> ''),
s AS (SELECT *, coalesce(bool_or(ok) OVER (PARTITION BY taxon_id), FALSE) AS hit FROM p WHERE score >= 90),
r AS (SELECT *, row_number() OVER (PARTITION BY taxon_id ORDER BY score DESC, col_id) AS rn FROM s WHERE ok OR NOT hit)
SELECT taxon_id, col_id, score FROM r WHERE rn <= 5 AND (SELECT bool_or(ok) FROM b)"""


@query("ent_05_crosswalk", f"SELECT taxon_id, col_id, match_type, match_score FROM ({EXACT}) UNION ALL SELECT * FROM ({HOMONYM.replace(FUZZY, _FALLBACK)})")
def _(r):
    return resolve.crosswalk(r.names, r.cat, *_lineages(r))


@query("ent_06_common_name", NAMES)
def _(r):
    return taxonomy.preferred_names(r.vern, r.xwalk)


DUP = """
WITH a AS (SELECT m.*, m.id_core IS NOT NULL AND m.id_core IN (SELECT photo_id FROM photos) AS pa, coalesce(m.sha256 IN (SELECT sha256 FROM media), FALSE) AS pb FROM manifest m),
b AS (SELECT *, row_number() OVER (PARTITION BY sha256, NOT pa AND NOT pb AND sha256 IS NOT NULL ORDER BY coalesce(file_bytes, 0) DESC, row_id) AS k FROM a)
SELECT row_id, CASE WHEN pa THEN 'photo_id' WHEN pb THEN 'media_sha256' WHEN sha256 IS NOT NULL AND k > 1 THEN 'sha256_within' END AS dup_reason FROM b"""


for _id, _kind in (("ent_07_pass_photo_id", "photo_id"), ("ent_08_pass_media_hash", "media_sha256"), ("ent_09_pass_within", "sha256_within")):
    query(_id, f"SELECT row_id FROM ({DUP}) WHERE dup_reason = '{_kind}'")(lambda r, k=_kind: resolve.media_duplicates(r.manifest, r.photos, r.media).where(F.col("dup_reason") == k).select("row_id"))


@query("ent_10_dup_columns", f"SELECT d.row_id, dup_reason, CASE dup_reason WHEN 'photo_id' THEN CAST(id_core AS VARCHAR) WHEN 'media_sha256' THEN sha256 WHEN 'sha256_within' THEN sha256 END AS matched_key, dup_reason IS NULL AS keep_flag FROM ({DUP}) d JOIN manifest m ON m.row_id = d.row_id")
def _(r):
    return resolve.media_duplicates(r.manifest, r.photos, r.media)


def _resolved(r):
    rows = r.table("part").selectExpr("p_partkey row_id", "case when p_partkey % 4 = 0 then concat('nation_', p_partkey % 30) when p_partkey % 4 = 1 then concat('Customer#', lpad(cast(p_partkey as string), 9, '0')) else p_name end name", "if(p_partkey % 3 = 0, 20D, null) rank_guess")
    return rows, resolve.resolve_names(rows, r.taxa)


RES_ROWS = "SELECT p_partkey AS row_id, CASE WHEN p_partkey % 4 = 0 THEN 'nation_' || (p_partkey % 30) WHEN p_partkey % 4 = 1 THEN 'Customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN 20.0 END AS guess FROM part"
RES = f"WITH r AS ({RES_ROWS}), j AS (SELECT row_id, t.taxon_id, count(t.taxon_id) OVER (PARTITION BY row_id) AS n, row_number() OVER (PARTITION BY row_id ORDER BY CASE WHEN guess IS NOT NULL THEN abs(t.rank_level - guess) END NULLS LAST, t.rank_level NULLS LAST, t.taxon_id) AS k FROM r LEFT JOIN taxa t ON lower(t.name) = lower(r.name) AND t.active) SELECT row_id, taxon_id, CASE n WHEN 0 THEN 'no_match' WHEN 1 THEN 'exact_match' ELSE 'multiple_match' END AS taxonomy_status FROM j WHERE k = 1"


@query("ent_11_resolve_names", RES)
def _(r):
    return _resolved(r)[1]


@query("ent_12_observation_key", "SELECT row_id, CASE WHEN id_core IS NOT NULL THEN 'name:' || scientific_name || '|id:' || id_core ELSE 'asset:' || row_id END AS obs_key FROM manifest")
def _(r):
    return r.manifest.select("row_id", resolve.observation_key("scientific_name").alias("obs_key"))


@query("ent_13_observation_per_key", "WITH c AS (SELECT 'k' || (row_id % 300) AS obs_key, CAST(row_id % 7 AS INTEGER) AS taxon_id, count(*) AS n FROM manifest WHERE row_id % 7 <> 3 GROUP BY ALL) SELECT obs_key, first(taxon_id ORDER BY n DESC, taxon_id) AS taxon_id, 'research' AS quality_grade FROM c GROUP BY obs_key")
def _(r):
    m = r.manifest.selectExpr("concat('k', row_id % 300) obs_key", "cast(if(row_id % 7 = 3, null, row_id % 7) as int) taxon_id")
    return resolve.observations_of_media(m).drop("observation_uuid")


@query("ent_14_media_rows", "SELECT row_id, 'file:///flat/' || sha256 || '.jpg' AS uri, '{\"row_id\":' || row_id || '}' AS sidecar FROM manifest WHERE sha256 IS NOT NULL")
def _(r):
    return r.manifest.where("sha256 is not null").select("row_id", F.concat(F.lit("file:///flat/"), scalar.flat_name("sha256", "filename")).alias("uri"), scalar.media_sidecar("row_id").alias("sidecar"))


@query("ent_15_links", "SELECT DISTINCT m.media_id, x.row_id % 300 AS obs FROM manifest x JOIN media m USING (sha256)")
def _(r):
    return r.manifest.join(r.media.select("sha256", "media_id"), "sha256").select("media_id", (F.col("row_id") % 300).alias("obs")).distinct()


@query("ent_16_duplicate_rate", "SELECT count(*) AS n, count(*) FILTER (id_core IN (SELECT photo_id FROM photos)) AS hits, CASE WHEN 100.0 * count(*) FILTER (id_core IN (SELECT photo_id FROM photos)) / count(*) > 90 THEN 'high' WHEN 100.0 * count(*) FILTER (id_core IN (SELECT photo_id FROM photos)) / count(*) > 70 THEN 'some' ELSE 'low' END AS verdict FROM manifest WHERE id_core IS NOT NULL")
def _(r):
    known = r.photos.select(F.col("photo_id").alias("id_core"), F.lit(True).alias("k")).distinct()
    s = r.manifest.where("id_core is not null").join(known, "id_core", "left").agg(F.count("*").alias("n"), F.count_if("k").alias("hits"))
    rate = 100.0 * F.col("hits") / F.col("n")
    return s.withColumn("verdict", F.when(rate > 90, "high").when(rate > 70, "some").otherwise("low"))


@query("ent_17_filename_profile", "SELECT regexp_extract(filename, '^([A-Za-z]+)', 1) AS stem, length(filename) AS len, count(*) AS n FROM manifest GROUP BY ALL")
def _(r):
    return r.manifest.groupBy(F.regexp_extract("filename", "^([A-Za-z]+)", 1).alias("stem"), F.length("filename").alias("len")).agg(F.count("*").alias("n"))


# ---- annotations
@query("ann_01_trust_rank", f"SELECT annotation_id, {TRUST} AS trust_rank FROM ann WHERE lifecycle_state = 'active'")
def _(r):
    return r.ann.where("lifecycle_state = 'active'").select("annotation_id", annotate.trust_rank(50).alias("trust_rank"))


@query("ann_02_active", "SELECT annotation_id FROM ann WHERE lifecycle_state = 'active' AND annotation_id NOT IN (SELECT superseded_annotation_id FROM edge)")
def _(r):
    return annotate.active(r.ann, r.edge).select("annotation_id")


@query("ann_03_policies", "SELECT * FROM (VALUES ('human_first', 1, 1), ('model_first', 1, 2), ('hybrid', 1, 1)) AS t(policy_name, policy_version, min_trust_rank)")
def _(r):
    return annotate.policies(r.spark).select("policy_name", "policy_version", "min_trust_rank")


@query("ann_04_source_priority", "SELECT annotation_id, CASE source_kind WHEN 'human' THEN 0 WHEN 'imported_dataset' THEN 1 ELSE 2 END AS h, CASE source_kind WHEN 'model' THEN 0 WHEN 'human' THEN 1 ELSE 2 END AS m FROM ann")
def _(r):
    return r.ann.select("annotation_id", annotate.source_priority(F.lit("human_first")).alias("h"), annotate.source_priority(F.lit("model_first")).alias("m"))


def _select_sql(priority: str, floor: int, scope: str = "TRUE") -> str:
    return f"SELECT annotation_id, trust_rank FROM (SELECT *, {TRUST} AS trust_rank FROM ann WHERE lifecycle_state = 'active' AND annotation_id NOT IN (SELECT superseded_annotation_id FROM edge)) WHERE trust_rank >= {floor} AND NOT coalesce(conflict_flag, FALSE) AND coalesce(review_status, 'unreviewed') <> 'rejected' AND {scope} QUALIFY row_number() OVER (PARTITION BY subject_id, label ORDER BY {priority}, trust_rank DESC, confidence DESC NULLS LAST, annotation_id) = 1"


MODEL_FIRST = "CASE source_kind WHEN 'model' THEN 0 WHEN 'human' THEN 1 ELSE 2 END"
HUMAN_FIRST = "CASE source_kind WHEN 'human' THEN 0 WHEN 'imported_dataset' THEN 1 ELSE 2 END"


@query("ann_05_selector_scoped", _select_sql(MODEL_FIRST, 2, "set_id IN (1, 2)"))
def _(r):
    return annotate.select_best(r.ann, r.edge, "model_first", 1, [1, 2], half=50).select("annotation_id", "trust_rank")


@query("ann_06_human_first", _select_sql(HUMAN_FIRST, 1))
def _(r):
    return annotate.select_best(r.ann, r.edge, "human_first", half=50).select("annotation_id", "trust_rank")


@query("ann_07_public_media", "SELECT media_id, uri FROM media WHERE license IS NULL OR license NOT IN ('unknown', 'restricted', 'all-rights-reserved')")
def _(r):
    return r.media.where(F.col("license").isNull() | ~F.col("license").isin("unknown", "restricted", "all-rights-reserved")).select("media_id", "uri")


# ---- releases
NEW = "SELECT observation_uuid, taxon_id FROM obs WHERE observed_on > (SELECT max(observed_on) FROM obs1) OR observation_uuid NOT IN (SELECT observation_uuid FROM obs1)"


@query("dlt_01_new_observations", NEW)
def _(r):
    return delta.new_observations(r.obs1, r.obs).select("observation_uuid", "taxon_id")


@query("dlt_02_taxa_of_new", f"SELECT DISTINCT taxon_id FROM ({NEW})")
def _(r):
    return delta.new_observations(r.obs1, r.obs).select("taxon_id").distinct()


CHANGE = """SELECT coalesce(a.taxon_id, b.taxon_id) AS taxon_id, CASE WHEN a.taxon_id IS NULL THEN 'NEW' WHEN b.taxon_id IS NULL THEN 'REMOVED' WHEN a.ancestry <> b.ancestry THEN 'BREAKING_ANCESTRY' WHEN a.rank_level <> b.rank_level THEN 'BREAKING_RANK_LEVEL' WHEN a.rank <> b.rank THEN 'BREAKING_RANK'
WHEN a.active AND NOT b.active THEN 'BREAKING_DEACTIVATION' WHEN a.name <> b.name THEN 'NAME_CHANGE' WHEN NOT a.active AND b.active THEN 'REACTIVATION' ELSE 'NO_CHANGE' END AS change FROM taxa a FULL JOIN taxa2 b ON a.taxon_id = b.taxon_id"""


@query("dlt_03_classify", CHANGE)
def _(r):
    return delta.classify(r.taxa, r.taxa2).select("taxon_id", "change")


@query("dlt_04_gate", f"SELECT CASE WHEN bool_or(change LIKE 'BREAKING%' OR change = 'REMOVED') THEN 'blocked' ELSE 'passed' END AS verdict FROM ({CHANGE})")
def _(r):
    try:
        delta.gate(delta.classify(r.taxa, r.taxa2))
        verdict = "passed"
    except ValueError:
        verdict = "blocked"
    return r.spark.createDataFrame([(verdict,)], "verdict string")


@query("dlt_04_gate_passes", f"SELECT CASE WHEN bool_or(change LIKE 'BREAKING%' OR change = 'REMOVED') THEN 'blocked' ELSE 'passed' END AS verdict FROM ({CHANGE.replace('JOIN taxa2 b', 'JOIN taxa b')})")
def _(r):
    """A release against itself."""
    delta.gate(delta.classify(r.taxa, r.taxa))
    return r.spark.createDataFrame([("passed",)], "verdict string")


@query("dlt_05_report", f"SELECT change, count(*) AS n FROM ({CHANGE}) GROUP BY change")
def _(r):
    return delta.classify(r.taxa, r.taxa2).groupBy("change").agg(F.count("*").alias("n"))


@query("dlt_06_top_changed", f"WITH c AS ({CHANGE}), n AS (SELECT taxon_id, count(*) AS n FROM ({NEW}) GROUP BY 1) SELECT taxon_id, change, n FROM c JOIN n USING (taxon_id) WHERE change <> 'NO_CHANGE' ORDER BY n DESC, taxon_id LIMIT 100")
def _(r):
    n = delta.new_observations(r.obs1, r.obs).groupBy("taxon_id").agg(F.count("*").alias("n"))
    return delta.classify(r.taxa, r.taxa2).where("change <> 'NO_CHANGE'").join(n, "taxon_id").select("taxon_id", "change", "n").orderBy(F.desc("n"), "taxon_id").limit(100)


MAPPING = """SELECT a.taxon_id, CASE WHEN b.taxon_id IS NULL THEN 'REMOVED' WHEN a.active AND NOT b.active THEN 'DEACTIVATED' WHEN a.rank_level <> b.rank_level THEN 'RANK_CHANGED' WHEN a.name <> b.name THEN 'RENAMED' END AS change_type, a.name, a.rank_level, a.ancestry, a.rank,
coalesce(n, 0) AS n_obs, coalesce(n, 0) > 5 AS high_impact FROM taxa a LEFT JOIN taxa2 b ON a.taxon_id = b.taxon_id LEFT JOIN (SELECT taxon_id, count(*) AS n FROM obs GROUP BY 1) o ON o.taxon_id = a.taxon_id"""


@query("dlt_07_mapping", f"SELECT taxon_id, change_type, name, n_obs, high_impact FROM ({MAPPING}) WHERE change_type IS NOT NULL")
def _(r):
    return delta.mapping(r.taxa, r.taxa2, r.obs, 5).select("taxon_id", "change_type", "name", "n_obs", "high_impact")


@query("dlt_08_impact", f"SELECT change_type, rank_level AS level, count(*) AS taxa, CAST(sum(n_obs) AS BIGINT) AS n_obs FROM ({MAPPING}) WHERE change_type IS NOT NULL GROUP BY ALL")
def _(r):
    return delta.mapping(r.taxa, r.taxa2, r.obs, 5).groupBy("change_type", F.col("old_rank_level").alias("level")).agg(F.count("*").alias("taxa"), F.sum("n_obs").alias("n_obs"))


@query("dlt_09_clade_impact", f"SELECT {CLADE_LABEL} AS clade, change_type, count(*) AS taxa, CAST(sum(n_obs) AS BIGINT) AS n_obs FROM ({MAPPING}) WHERE change_type IS NOT NULL AND high_impact GROUP BY ALL")
def _(r):
    m = delta.mapping(r.taxa, r.taxa2, r.obs, 5).where("high_impact").withColumnRenamed("old_ancestry", "ancestry")
    return m.groupBy(F.expr(CLADE_LABEL).alias("clade"), "change_type").agg(F.count("*").alias("taxa"), F.sum("n_obs").alias("n_obs"))


@query("dlt_10_rules", f"SELECT * FROM ({RULES}) QUALIFY row_number() OVER (PARTITION BY old_id ORDER BY kind, new_id) = 1")
def _(r):
    return delta.remap_rules(r.taxa, r.taxa2)


@query("dlt_11_suggestions", "SELECT taxon_id, CASE rank WHEN 'subspecies' THEN 'map to species' WHEN 'species' THEN 'review synonyms' WHEN 'genus' THEN 'review children' ELSE 'review by hand' END AS action FROM taxa")
def _(r):
    return r.taxa.select("taxon_id", delta.suggested_action().alias("action"))


@query("dlt_12_audit", f"WITH n AS ({REMAP}) SELECT o.observation_uuid, o.taxon_id AS old_id, n.taxon_id AS new_id FROM obs o JOIN n USING (observation_uuid) WHERE o.taxon_id <> n.taxon_id")
def _(r):
    rules = delta.remap_rules(r.taxa, r.taxa2)
    return delta.audit(r.obs, delta.remap(r.obs, rules), rules).select("observation_uuid", "old_id", "new_id")


@query("dlt_13_watched_diff", "SELECT a.taxon_id, a.name AS old_name, b.name AS new_name FROM taxa a JOIN taxa2 b USING (taxon_id) WHERE a.taxon_id < 40000 AND (a.ancestry <> b.ancestry OR a.rank_level <> b.rank_level OR a.rank <> b.rank OR a.name <> b.name OR a.active <> b.active)")
def _(r):
    return delta.changed(r.taxa.where("taxon_id < 40000"), r.taxa2).select("taxon_id", "old_name", "new_name")


# ---- older forms
LEG = f"SELECT DISTINCT o.taxon_id FROM obs o JOIN taxa t USING (taxon_id) WHERE {IN_EUR} AND NOT (rank_level = 10 AND quality_grade <> 'research') AND o.taxon_id IN (SELECT taxon_id FROM obs GROUP BY taxon_id HAVING count(observation_uuid) >= 8)"


@query("leg_01_region_taxa", LEG)
def _(r):
    return legacy.region_taxa(r.obs, r.taxa, EUR, 8)


@query("leg_02_region_observations", f"SELECT observation_uuid FROM obs WHERE taxon_id IN ({LEG})")
def _(r):
    return legacy.region_observations(r.obs, legacy.region_taxa(r.obs, r.taxa, EUR, 8)).select("observation_uuid")


@query("leg_03_clade_children", "WITH o AS (SELECT o.observation_uuid, t.name, row_number() OVER (PARTITION BY o.taxon_id ORDER BY md5(observation_uuid), observation_uuid) AS k FROM obs o JOIN taxa t USING (taxon_id) WHERE ancestry LIKE '1001/2001/%') SELECT observation_uuid, name, photo_id FROM o JOIN photos USING (observation_uuid) WHERE k <= 3")
def _(r):
    return legacy.clade_children(r.obs, r.photos, r.taxa, "1001/2001/", 3).select("observation_uuid", "name", "photo_id")


# ---- streams (an extension)
def _dropped(r, df, batches: int = 3, fmt: str = "parquet", **options) -> tuple[str, int]:
    """A folder with the rows, and how many of its files make a batch. Files are as many as the rows have partitions, or a batch each where those are fewer, so they don't grow with the table."""
    folder = scratch(r.spark)
    df.write.format(fmt).options(**options).save(folder)
    files = len(r.spark.read.text(folder).inputFiles())
    if files < batches:
        small, folder, files = r.spark.read.format(fmt).options(**options).schema(df.schema).load(folder), scratch(r.spark), batches
        small.repartition(batches).write.format(fmt).options(**options).save(folder)
    return folder, -(-files // batches)


def _stream(r, name: str, schema=None):
    folder, files = _dropped(r, r.table(name))
    return jobs.drops(r.spark, folder, schema or r.table(name).schema, files)


def _drained(r, stream, how="append"):
    out = scratch(r.spark)
    stream.writeStream.outputMode(how).format("parquet").option("path", out).option("checkpointLocation", scratch(r.spark)).trigger(availableNow=True).start().awaitTermination()
    return r.spark.read.schema(stream.schema).parquet(out)


@query("str_01_first_seen", "SELECT event_id FROM events")
def _(r):
    return _drained(r, jobs.first_seen(_stream(r, "events"), "event_id", "ts", "1000 days").select("event_id"))


@query("str_02_idempotent_insert", "SELECT event_id, event_type FROM events")
def _(r):
    target = scratch(r.spark)
    merge = jobs.upsert_into(target, "event_id")
    for _ in range(2):
        jobs.run_available(_stream(r, "events").select("event_id", "event_type"), merge, scratch(r.spark))
    return r.spark.read.parquet(target)


@query("str_03_resumed_fill", f"WITH g AS ({GRID}) SELECT observation_uuid, elevation FROM g WHERE elevation IS NOT NULL")
def _(r):
    (folder, files), out, mark = _dropped(r, r.obs), scratch(r.spark), scratch(r.spark)
    for _ in range(2):
        stream = jobs.drops(r.spark, folder, r.obs.schema, files)
        filled = geo.sample_grid(stream, r.cells, -18000, -9000, 1000).where("elevation is not null").select("observation_uuid", "elevation")
        filled.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return r.spark.read.parquet(out)


@query("str_04_window_rate", "SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS start, count(*) AS n FROM events GROUP BY 1")
def _(r):
    """Each batch appends the windows that it changed to a table; the last row of a window counts, so no state comes to the driver."""
    out = scratch(r.spark)

    def put(batch, k):
        batch.select("start", "n").withColumn("batch", F.lit(k)).write.mode("append").parquet(out)

    jobs.rates(_stream(r, "events"), late="30 days").writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", scratch(r.spark)).trigger(availableNow=True).start().awaitTermination()
    last = r.spark.read.schema("start timestamp, n bigint, batch bigint").parquet(out).groupBy("start").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("str_05_file_drop", "SELECT taxon_id, rank FROM taxa")
def _(r):
    folder, files = _dropped(r, r.taxa, 2, "csv", sep="\t", quote="", header="true")
    return _drained(r, jobs.drops(r.spark, folder, schemas.dump("taxa"), files, fmt="csv", sep="\t", header="true").select("taxon_id", "rank"))


# ---- user functions
@query("udf_01_expand_call", "SELECT count(*) AS n FROM wide")
def _(r):
    return taxonomy.expand(r.taxa).agg(F.count("*").alias("n"))


@query("udf_02_table_function", _select_sql(MODEL_FIRST, 2))
def _(r):
    return annotate.select_best(r.ann, r.edge, "model_first", half=50).select("annotation_id", "trust_rank")


@query("udf_03_trigger_rules", """
WITH w AS (SELECT annotation_id, lifecycle_state, annotation_id % 7 = 0 AS bare, annotation_id % 11 = 0 AS gone FROM ann), s AS (SELECT superseded_annotation_id AS id FROM edge)
SELECT annotation_id, CASE WHEN annotation_id IN (SELECT id FROM s) THEN 'superseded' ELSE lifecycle_state END AS lifecycle_state,
  concat_ws(',', CASE WHEN bare THEN 'no_provenance' END, CASE WHEN gone AND annotation_id IN (SELECT id FROM s) THEN 'lineage_delete' END) AS refused, annotation_id % 5 = 0 AS touched FROM w""")
def _(r):
    """The four triggers in one write: provenance must exist, a superseded row follows its edge, rows of a lineage may not be deleted, and changed rows get the time of the write."""
    w = r.ann.withColumns({"changed": F.col("annotation_id") % 5 == 0, "deleted": F.col("annotation_id") % 11 == 0})
    out = quality.gated_write(w, r.ann.where("annotation_id % 7 <> 0").select("annotation_id"), r.edge, F.lit("2030-01-01").cast("timestamp"))
    return out.select("annotation_id", "lifecycle_state", F.array_join("refused", ",").alias("refused"), F.col("updated_at").isNotNull().alias("touched"))


@query("udf_04_row_functions", f"SELECT taxon_id, {NORM} AS n, length({NORM}) AS size FROM names")
def _(r):
    """A Python function over frames, in Arrow batches."""

    def rows(frames):
        for f in frames:
            n = f["name"].str.lower().str.replace(r"\s+", " ", regex=True).str.strip()
            yield f[["taxon_id"]].assign(n=n, size=n.str.len())

    return r.names.select("taxon_id", "name").mapInPandas(rows, "taxon_id int, n string, size bigint")



# ---- further names of the inventory
@query("jon_17_audit_join", f"WITH n AS ({REMAP}), r AS ({RULES}) SELECT o.observation_uuid, r.kind FROM obs o JOIN n USING (observation_uuid) JOIN r ON r.old_id = o.taxon_id WHERE o.taxon_id <> n.taxon_id")
def _(r):
    rules = delta.remap_rules(r.taxa, r.taxa2)
    return delta.audit(r.obs, delta.remap(r.obs, rules), rules).select("observation_uuid", "kind")


@query("jon_23_range_join", "SELECT t.ts_key, a.annotation_id FROM (SELECT event_id AS ts_key, ts FROM events) t JOIN ann a ON a.created_at >= t.ts AND a.created_at < t.ts + INTERVAL 10 MINUTE")
def _(r):
    """The intervals of all events."""
    return _within_ten_minutes(r, r.table("events"))


def _within_ten_minutes(r, events):
    """A range join as an equality on cells of 150 seconds: each interval is in the four or five cells that it touches, so four of five pairs that meet are in it."""
    cell = lambda c, off=0: F.floor((F.unix_micros(F.col(c).cast("timestamp")) + off) / 150_000_000)
    t = events.select(F.col("event_id").alias("ts_key"), "ts", F.expr("ts + interval 10 minutes").alias("_end"), F.explode(F.sequence(cell("ts"), cell("ts", 599_999_999))).alias("_cell"))
    a = r.ann.select("annotation_id", "created_at", cell("created_at").alias("_cell"))
    return pairs.pairs(t, a, "_cell").where("created_at >= ts and created_at < _end").select("ts_key", "annotation_id")


@query("win_09_lag_frames", "SELECT annotation_id, lag(annotation_id) OVER w AS before, CAST(sum(confidence) OVER (PARTITION BY subject_id ORDER BY annotation_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent FROM ann WINDOW w AS (PARTITION BY subject_id ORDER BY annotation_id)")
def _(r):
    w = Window.partitionBy("subject_id").orderBy("annotation_id")
    return r.ann.select("annotation_id", F.lag("annotation_id").over(w).alias("before"), F.sum("confidence").over(w.rowsBetween(-2, 0)).alias("recent"))


@query("dml_04_partial_rank_wipe", """
WITH j AS (SELECT observation_uuid, "L20_taxonID" AS g FROM obs JOIN wide ON "taxonID" = taxon_id), a AS (SELECT g, count(*) AS n FROM j GROUP BY g)
SELECT observation_uuid, CASE WHEN a.n >= 125 THEN j.g END AS "L20_taxonID" FROM j LEFT JOIN a ON a.g = j.g""")
def _(r):
    return export.wipe_rare(export.with_taxonomy(r.obs, r.wide), 20, 125).select("observation_uuid", "L20_taxonID")


@query("dml_12_append_only", "SELECT annotation_id, label FROM ann")
def _(r):
    """A second append of the same rows changes nothing: rows are added by key, never replaced or removed."""
    kept = r.ann.select("annotation_id", "label")
    return delta.insert_absent(kept, kept.withColumn("label", F.lit("changed")), "annotation_id")


@query("dml_13_touched_on_write", "SELECT annotation_id, CASE WHEN label = 'click' THEN 'checked' ELSE label END AS label, label = 'click' AS touched FROM ann")
def _(r):
    """A write that changes the label of some rows: they get the time of the write, rows that it leaves as they are don't."""
    new = r.ann.withColumn("new", F.when(F.col("label") == "click", "checked").otherwise(F.col("label")))
    w = new.withColumn("changed", ~F.col("new").eqNullSafe(F.col("label"))).drop("label").withColumnRenamed("new", "label")
    return quality.touched(w, F.current_timestamp()).select("annotation_id", "label", F.col("updated_at").isNotNull().alias("touched"))


@query("snk_10_update_in_place", f'SELECT "taxonID", "rankLevel", CASE WHEN "rankLevel" IN (10, 20) THEN {IMM} END AS up FROM wide')
def _(r):
    """A table by rank of which two ranks get a column's values: only their partitions are written again, the others stay as they are."""
    up, _ = taxonomy.immediate_ancestor()
    path = scratch(r.spark)
    r.wide.select("taxonID", F.lit(None).cast("int").alias("up"), "rankLevel").write.partitionBy("rankLevel").parquet(path)
    old = r.spark.read.schema("taxonID int, up int, rankLevel double").parquet(path)
    new = old.where("rankLevel in (10, 20)").drop("up").join(r.wide.select("taxonID", up.alias("up")), "taxonID")
    new.select("taxonID", "up", "rankLevel").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rankLevel").parquet(path)
    return r.spark.read.schema("taxonID int, up int, rankLevel double").parquet(path)


@query("snk_12_diff_files", "SELECT taxon_id FROM taxa WHERE taxon_id NOT IN (SELECT taxon_id FROM taxa2)")
def _(r):
    path = scratch(r.spark)
    r.taxa.join(r.taxa2, "taxon_id", "left_anti").select("taxon_id").write.csv(path, header=True)
    return r.spark.read.csv(path, header=True, schema="taxon_id int")


@query("src_10_file_dispatch", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM cat WHERE CAST(substr(col_id, 2) AS INTEGER) % 6 = {k}" for k, t in enumerate(files.CATALOGUE_FILES)))
def _(r):
    """Six files of a catalogue, each read as the table that its name stands for."""
    folder = scratch(r.spark)
    for k, f in enumerate(files.CATALOGUE_FILES.values()):
        r.cat.where(F.substring("col_id", 2, 99).cast("int") % 6 == k).select(F.col("col_id").alias("col:ID"), F.col("name").alias("col:scientificName")).write.csv(f"{folder}/{f}", sep="\t", header=True, quote="")
    return sinks.counts(**files.catalogue_tables(r.spark, folder)).withColumnRenamed("table", "table_name")


@query("src_12_raster_tiles", "SELECT CAST(r_regionkey * 40 + c AS BIGINT) AS cell, CAST((r_regionkey * 37 + c * c) % 500 AS DOUBLE) AS elevation FROM region, (SELECT unnest(range(40)) AS c) WHERE c % 9 <> 4")
def _(r):
    """Grids as text files, one for each region, read in tiles of three columns."""
    folder = scratch(r.spark)
    grid = r.table("region").select("r_regionkey", F.transform(F.sequence(F.lit(0), F.lit(39)), lambda c: F.when(c % 9 == 4, -9999).otherwise((F.col("r_regionkey") * 37 + c * c) % 500).cast("string")).alias("v"))
    body = F.concat(F.lit("ncols 8\nnrows 5\nxllcorner "), (F.col("r_regionkey") * 100).cast("string"), F.lit("\nyllcorner 0\ncellsize 1\nNODATA_value -9999\n"), F.array_join("v", " "))
    for k, in r.table("region").select("r_regionkey").collect():
        grid.where(F.col("r_regionkey") == k).select(body).coalesce(1).write.text(f"{folder}/{k}")
    tiles = files.ascii_grids(r.spark, f"{folder}/*/", 3, "part-*.txt")
    cells = tiles.select("ulx", "uly", "cols", "nodata", F.posexplode("values").alias("k", "elevation")).where("elevation <> nodata")
    x, y = F.col("ulx") + F.col("k") % F.col("cols"), 5 - F.col("uly") + F.floor(F.col("k") / F.col("cols"))
    return cells.select((F.floor(x / 100) * 40 + y * 8 + x % 100).cast("bigint").alias("cell"), F.col("elevation").cast("double").alias("elevation"))


def _images(r):
    """A folder with a file for each nation, and one of another kind."""
    folder = scratch(r.spark)
    fs, root = pafs.FileSystem.from_uri(folder)
    for name, text in [(f"{x.n_nationkey}.jpg", x.n_name * (x.n_nationkey + 1)) for x in r.table("nation").collect()] + [("notes.txt", "no image")]:
        fs.create_dir(f"{root}/{len(name)}", recursive=True)
        with fs.open_output_stream(f"{root}/{len(name)}/{name}") as f:
            f.write(text.encode())
    return folder


@query("src_14_image_scan", "SELECT n_nationkey || '.jpg' AS filename, CAST(length(n_name) * (n_nationkey + 1) AS BIGINT) AS bytes, sha256(repeat(n_name, n_nationkey + 1)) AS sha256 FROM nation")
def _(r):
    return files.images(r.spark, _images(r)).select("filename", "bytes", "sha256")


@query("snk_13_materialise_files", "SELECT 'n_' || n_nationkey || '.jpg' AS flat_name, 'linked' AS first, 'present' AS again FROM nation")
def _(r):
    """Files laid flat in a folder by links; a second run finds them there."""
    target = scratch(r.spark)
    pafs.FileSystem.from_uri(target)[0].create_dir(pafs.FileSystem.from_uri(target)[1], recursive=True)
    flat = files.images(r.spark, _images(r)).select("path", F.concat(F.lit("n_"), "filename").alias("flat_name"))
    first, again = (kept(sinks.materialise_files(flat, pafs.FileSystem.from_uri(target)[1])) for _ in range(2))
    return first.withColumnRenamed("result", "first").join(again.withColumnRenamed("result", "again"), "flat_name")


@query("dml_16_analyze", "SELECT 'taxa' AS name, count(*) AS n, count(DISTINCT rank) AS ranks FROM taxa")
def _(r):
    """Statistics of a table and a column for the cost-based optimiser."""
    name, path = "taxa_" + scratch(r.spark).rsplit("/", 1)[1], scratch(r.spark)
    r.taxa.write.parquet(path)
    r.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    r.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS rank")
    size = r.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").select(F.regexp_extract("data_type", "([0-9]+) rows", 1).cast("bigint")).first()[0]
    ranks = r.spark.sql(f"DESCRIBE EXTENDED {name} rank").where("info_name = 'distinct_count'").select(F.col("info_value").cast("bigint")).first()[0]
    r.spark.sql(f"DROP TABLE {name}")
    return r.spark.createDataFrame([("taxa", size, ranks)], "name string, n bigint, ranks bigint")


@query("src_15_manifest_reader", "SELECT row_id, id_core, row_id % 2 = 0 AS keep_flag FROM manifest")
def _(r):
    path = scratch(r.spark)
    r.manifest.select("row_id", "id_core", F.when(F.col("row_id") % 2 == 0, "True").otherwise("no").alias("keep_flag")).write.csv(path, header=True)
    return files.manifest(r.spark, path).withColumn("row_id", F.col("row_id").cast("bigint"))


@query("src_21_path_records", "SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def _(r):
    return r.table("pages").select("page_id", F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("host"))


@query("udf_05_registered_function", f"SELECT taxon_id, {NORM} AS n FROM names WHERE length({NORM}) > 20")
def _(r):
    """A function registered in the session and called from SQL; Catalyst inlines its body."""
    r.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sylva_name(x STRING) RETURNS STRING RETURN trim(regexp_replace(lower(x), '\\\\s+', ' '))")
    return r.spark.sql("SELECT taxon_id, sylva_name(name) AS n FROM {names} WHERE length(sylva_name(name)) > 20", names=r.names)
