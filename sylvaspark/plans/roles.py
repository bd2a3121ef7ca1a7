"""The driver's tables in the roles of observations, photos, taxa and so on: as DataFrames, and as SQL for the oracle.

Only integer, text and date arithmetic, so that both engines agree to the bit. Positions are whole hundredths of a degree.
"""

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvaspark.operators import taxonomy
from sylvaspark.plans.scratch import kept

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

#: Duck SQL of each role; a role may use those before it.
SQL = {
    "seg": "SELECT * FROM (VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(SEGMENTS)) + ") AS t(segment, k)",
    "taxa": """
SELECT CAST(1000 + r_regionkey AS INTEGER) AS taxon_id, '' AS ancestry, 70.0::DOUBLE AS rank_level, 'kingdom' AS rank, r_name AS name, TRUE AS active FROM region
UNION ALL SELECT CAST(2000 + n_nationkey AS INTEGER), CAST(1000 + n_regionkey AS VARCHAR), 40.0, 'order', n_name, TRUE FROM nation
UNION ALL SELECT CAST(30000 + n_nationkey * 10 + k AS INTEGER), (1000 + n_regionkey) || '/' || (2000 + n_nationkey), 20.0, 'genus', n_name || ' ' || segment, (n_nationkey + k) % 11 <> 0 FROM nation, seg
UNION ALL SELECT CAST(100000 + c_custkey AS INTEGER), (1000 + n_regionkey) || CASE WHEN c_custkey % 7 = 3 THEN '' ELSE '/' || (2000 + n_nationkey) END || '/' || (30000 + n_nationkey * 10 + k), 10.0, 'species', c_name, c_custkey % 17 <> 0
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN seg ON c_mktsegment = segment
UNION ALL SELECT CAST(9000000 + c_custkey AS INTEGER), (1000 + n_regionkey) || '/' || (2000 + n_nationkey) || '/' || (30000 + n_nationkey * 10 + k) || '/' || (100000 + c_custkey), 5.0, 'subspecies', CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_name || ' minor' END, TRUE
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN seg ON c_mktsegment = segment WHERE c_custkey % 5 = 0""",
    "obs": """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS observation_uuid, o_orderkey AS obs_key, CAST(o_orderkey % 97 AS INTEGER) AS observer_id, CAST((o_orderkey * 104729) % 18000 - 9000 AS INTEGER) AS latitude,
  CAST((o_orderkey * 7919) % 36000 - 18000 AS INTEGER) AS longitude, CAST(o_orderkey % 1000 AS INTEGER) AS positional_accuracy,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 30000 + c_nationkey * 10 + k WHEN o_orderkey % 23 = 1 AND c_custkey % 5 = 0 THEN 9000000 + c_custkey ELSE 100000 + c_custkey END AS INTEGER) AS taxon_id,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'research' WHEN o_orderstatus = 'O' THEN 'needs_id' ELSE 'casual' END AS quality_grade, CAST(o_orderdate AS DATE) AS observed_on,
  CAST(o_orderkey % 100 AS INTEGER) AS anomaly_score
FROM orders JOIN customer ON o_custkey = c_custkey JOIN seg ON c_mktsegment = segment""",
    "photos": """
SELECT md5(CAST(l_orderkey * 100 + pos AS VARCHAR)) AS photo_uuid, l_orderkey * 100 + pos AS photo_id, md5(CAST(l_orderkey AS VARCHAR)) AS observation_uuid, CAST(l_orderkey % 97 AS INTEGER) AS observer_id,
  CASE l_linestatus WHEN 'O' THEN 'jpg' ELSE 'jpeg' END AS extension, CASE l_returnflag WHEN 'A' THEN 'CC-BY' WHEN 'N' THEN 'unknown' ELSE NULL END AS license, CAST(l_partkey % 2048 AS INTEGER) AS width, CAST(l_suppkey % 2048 AS INTEGER) AS height, CAST(pos AS INTEGER) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos FROM lineitem)""",
    "taxa2": """
SELECT taxon_id, CASE WHEN taxon_id % 23 = 0 THEN ancestry || '/1' ELSE ancestry END AS ancestry, CASE WHEN taxon_id % 7 = 0 THEN rank_level + 1 ELSE rank_level END AS rank_level,
  CASE WHEN taxon_id % 29 = 0 THEN rank || 'x' ELSE rank END AS rank, CASE WHEN taxon_id % 11 = 0 THEN name || ' nova' ELSE name END AS name, CASE WHEN taxon_id % 19 = 0 THEN FALSE WHEN taxon_id % 31 = 0 THEN TRUE ELSE active END AS active
FROM taxa WHERE taxon_id % 13 <> 0 OR rank_level > 10
UNION ALL SELECT taxon_id + 20000000, ancestry, rank_level, rank, name || ' sp. nov.', active FROM taxa WHERE rank_level = 10 AND taxon_id % 37 = 0""",
    "obs1": "SELECT * FROM obs WHERE obs_key % 10 <> 0 AND observed_on < DATE '1998-06-01'",
    "ann": """
SELECT event_id AS annotation_id, user_id AS subject_id, event_type AS label, CAST(event_id % 4 AS INTEGER) AS set_id, CASE event_id % 3 WHEN 0 THEN 'human' WHEN 1 THEN 'model' ELSE 'imported_dataset' END AS source_kind,
  CASE event_id % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'unreviewed' WHEN 2 THEN 'accepted' WHEN 3 THEN 'rejected' ELSE NULL END AS review_status, CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) % 101 END AS confidence,
  CASE WHEN event_id % 19 = 0 THEN TRUE WHEN event_id % 19 = 1 THEN NULL ELSE FALSE END AS conflict_flag, CASE WHEN event_id % 50 = 3 THEN 'draft' ELSE 'active' END AS lifecycle_state, props AS sidecar, ts AS created_at
FROM events""",
    "edge": "SELECT event_id AS superseded_annotation_id, event_id + 1 AS replacement_annotation_id FROM events WHERE event_id % 50 = 0",
    "manifest": """
SELECT doc_id AS row_id, CASE WHEN doc_id % 43 = 0 THEN NULL ELSE sha256(text) END AS sha256, CASE WHEN doc_id % 31 = 0 THEN NULL ELSE n_chars END AS file_bytes, CASE WHEN doc_id % 3 = 0 THEN doc_id * 100 ELSE NULL END AS id_core,
  'Genus' || (doc_id % 25) || '_species_' || (100000 + doc_id) || CASE WHEN doc_id % 2 = 0 THEN '_' || (doc_id % 5) ELSE '' END || '.jpg' AS filename, source AS scientific_name
FROM documents""",
    "media": "SELECT item_id AS media_id, sha256(text) AS sha256, 'file:///' || item_id AS uri, CASE item_id % 4 WHEN 0 THEN 'CC-BY' WHEN 1 THEN 'unknown' WHEN 2 THEN 'restricted' ELSE NULL END AS license FROM benchmark UNION ALL SELECT 1000000 + doc_id, sha256(CASE WHEN doc_id % 50 = 7 THEN text ELSE text || '~' END), 'file:///d' || doc_id, 'all-rights-reserved' FROM documents",
    "cat": """
SELECT 'C' || p_partkey AS col_id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name, CASE p_partkey % 4 WHEN 0 THEN 'genus' WHEN 1 THEN NULL ELSE 'species' END AS rank, CASE p_partkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'synonym' ELSE 'provisionally accepted' END AS status
FROM part""",
    "names": """
SELECT CAST(p_partkey AS INTEGER) AS taxon_id, CASE WHEN p_partkey % 7 = 0 THEN p_name || '  ' ELSE p_name END || CASE WHEN p_partkey % 11 = 0 THEN ' x' ELSE '' END AS name, CASE p_partkey % 3 WHEN 0 THEN 'genus' WHEN 1 THEN 'species' ELSE NULL END AS rank
FROM part""",
    "vern": """
SELECT 'C' || p_partkey AS col_id, p_type || ' ' || p_size AS name, CASE p_size % 3 WHEN 0 THEN 'eng' WHEN 1 THEN 'eng' ELSE 'fra' END AS language, CASE p_size % 4 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS preferred FROM part
UNION ALL SELECT 'C' || p_partkey, p_brand, 'eng', p_size % 2 = 0 FROM part""",
    "xwalk": "SELECT taxon_id, 'C' || (taxon_id % 200) AS col_id FROM taxa WHERE taxon_id % 3 <> 0",
    "cells": "SELECT CAST(p_partkey % 36 AS INTEGER) AS ix, CAST(p_partkey // 36 % 18 AS INTEGER) AS iy, max(CASE WHEN p_partkey % 29 = 0 THEN -9999 ELSE CAST(floor(p_retailprice) AS INTEGER) END) AS elevation FROM part GROUP BY ALL",
}


def _wide_sql() -> str:
    """expanded_taxa of the oracle: by look-ups of path elements, one rank after the other."""
    slots = ", ".join(f"max(CASE WHEN a.rank_level = {lv} THEN a.taxon_id END) AS {s}_taxonID, max(CASE WHEN a.rank_level = {lv} THEN a.name END) AS {s}_name" for lv, s in ((5, "L5"), (10, "L10"), (20, "L20"), (40, "L40"), (70, "L70")))
    return f"""
SELECT t.taxon_id AS "taxonID", any_value(t.rank_level) AS "rankLevel", any_value(t.rank) AS rank, any_value(t.name) AS name, TRUE AS "taxonActive", {slots}
FROM (SELECT *, unnest(list_append(CASE WHEN ancestry = '' THEN [] ELSE list_transform(string_split(ancestry, '/'), lambda x: CAST(x AS INTEGER)) END, taxon_id)) AS anc FROM taxa WHERE active) t
LEFT JOIN taxa a ON a.taxon_id = t.anc AND a.name IS NOT NULL GROUP BY t.taxon_id"""


SQL["wide"] = _wide_sql()
#: Ancestors by one row each: (taxon, ancestor or self).
SQL["line"] = 'SELECT "taxonID" AS sp, unnest([L5_taxonID, L10_taxonID, L20_taxonID, L40_taxonID, L70_taxonID]) AS anc FROM wide'


def with_roles(body: str) -> str:
    """The SQL with the roles that it names, as common table expressions."""
    need: list[str] = []

    def add(text: str) -> None:
        for name, sql in SQL.items():
            if name not in need and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                add(sql)
                need.append(name)

    add(body)
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in need)
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body.lstrip()[15:]}"
    return f"WITH {ctes}, {body.lstrip()[5:]}" if body.lstrip().upper().startswith("WITH ") else f"WITH {ctes} {body}"


_wide: dict[tuple[str, str], DataFrame] = {}


class Roles:
    """The roles over one folder of the driver's tables; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def _species(self) -> DataFrame:
        k = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")).cast("int") - 1
        return self.table("customer").join(F.broadcast(self.table("nation")), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("k", k)

    @cached_property
    def taxa(self) -> DataFrame:
        nation = self.table("nation")
        kind = "cast({} as int) taxon_id", "{} ancestry", "cast({} as double) rank_level", "'{}' rank", "{} name", "{} active"
        pick = lambda df, *v: df.selectExpr(*[k.format(x) for k, x in zip(kind, v)])
        path = "concat(1000 + n_regionkey, '/', 2000 + n_nationkey)"
        genus = "30000 + n_nationkey * 10 + k"
        out = [pick(self.table("region"), "1000 + r_regionkey", "''", 70, "kingdom", "r_name", "true"), pick(nation, "2000 + n_nationkey", "cast(1000 + n_regionkey as string)", 40, "order", "n_name", "true")]
        seg = self.spark.createDataFrame([(s, i) for i, s in enumerate(SEGMENTS)], "segment string, k int")
        out.append(pick(nation.crossJoin(F.broadcast(seg)), genus, path, 20, "genus", "concat(n_name, ' ', segment)", "(n_nationkey + k) % 11 <> 0"))
        out.append(pick(self._species, "100000 + c_custkey", f"concat(1000 + n_regionkey, case when c_custkey % 7 = 3 then '' else concat('/', 2000 + n_nationkey) end, '/', {genus})", 10, "species", "c_name", "c_custkey % 17 <> 0"))
        sub = self._species.where("c_custkey % 5 = 0")
        out.append(pick(sub, "9000000 + c_custkey", f"concat({path}, '/', {genus}, '/', 100000 + c_custkey)", 5, "subspecies", "case when c_custkey % 15 = 0 then null else concat(c_name, ' minor') end", "true"))
        df = out[0]
        for x in out[1:]:
            df = df.unionByName(x)
        return df

    @cached_property
    def obs(self) -> DataFrame:
        df = self.table("orders").join(self._species, F.col("o_custkey") == F.col("c_custkey"))
        return df.selectExpr(
            "md5(cast(o_orderkey as string)) observation_uuid", "o_orderkey obs_key", "cast(o_orderkey % 97 as int) observer_id", "cast((o_orderkey * 104729) % 18000 - 9000 as int) latitude",
            "cast((o_orderkey * 7919) % 36000 - 18000 as int) longitude", "cast(o_orderkey % 1000 as int) positional_accuracy",
            "cast(case when o_orderkey % 5 = 0 then 30000 + c_nationkey * 10 + k when o_orderkey % 23 = 1 and c_custkey % 5 = 0 then 9000000 + c_custkey else 100000 + c_custkey end as int) taxon_id",
            "case when o_orderkey % 41 = 0 then null when o_orderstatus = 'F' then 'research' when o_orderstatus = 'O' then 'needs_id' else 'casual' end quality_grade", "cast(o_orderdate as date) observed_on", "cast(o_orderkey % 100 as int) anomaly_score",
        )

    @cached_property
    def photos(self) -> DataFrame:
        w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        df = self.table("lineitem").select("*", (F.row_number().over(w) - 1).alias("pos"))
        return df.selectExpr(
            "md5(cast(l_orderkey * 100 + pos as string)) photo_uuid", "l_orderkey * 100 + pos photo_id", "md5(cast(l_orderkey as string)) observation_uuid", "cast(l_orderkey % 97 as int) observer_id", "if(l_linestatus = 'O', 'jpg', 'jpeg') extension",
            "case l_returnflag when 'A' then 'CC-BY' when 'N' then 'unknown' end license", "cast(l_partkey % 2048 as int) width", "cast(l_suppkey % 2048 as int) height", "cast(pos as int) position",
        )

    @cached_property
    def taxa2(self) -> DataFrame:
        old = self.taxa.where("taxon_id % 13 <> 0 or rank_level > 10").selectExpr(
            "taxon_id", "if(taxon_id % 23 = 0, concat(ancestry, '/1'), ancestry) ancestry", "if(taxon_id % 7 = 0, rank_level + 1, rank_level) rank_level", "if(taxon_id % 29 = 0, concat(rank, 'x'), rank) rank",
            "if(taxon_id % 11 = 0, concat(name, ' nova'), name) name", "case when taxon_id % 19 = 0 then false when taxon_id % 31 = 0 then true else active end active",
        )
        return old.unionByName(self.taxa.where("rank_level = 10 and taxon_id % 37 = 0").selectExpr("taxon_id + 20000000 taxon_id", "ancestry", "rank_level", "rank", "concat(name, ' sp. nov.') name", "active"))

    @cached_property
    def obs1(self) -> DataFrame:
        return self.obs.where("obs_key % 10 <> 0 and observed_on < date'1998-06-01'")

    @cached_property
    def ann(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id annotation_id", "user_id subject_id", "event_type label", "cast(event_id % 4 as int) set_id", "case event_id % 3 when 0 then 'human' when 1 then 'model' else 'imported_dataset' end source_kind",
            "case event_id % 5 when 0 then 'accepted' when 1 then 'unreviewed' when 2 then 'accepted' when 3 then 'rejected' end review_status", "if(event_id % 17 = 0, null, cast(floor(value) as int) % 101) confidence",
            "case when event_id % 19 = 0 then true when event_id % 19 = 1 then null else false end conflict_flag", "if(event_id % 50 = 3, 'draft', 'active') lifecycle_state", "props sidecar", "ts created_at",
        )

    @cached_property
    def edge(self) -> DataFrame:
        return self.table("events").where("event_id % 50 = 0").selectExpr("event_id superseded_annotation_id", "event_id + 1 replacement_annotation_id")

    @cached_property
    def manifest(self) -> DataFrame:
        return self.table("documents").selectExpr(
            "doc_id row_id", "if(doc_id % 43 = 0, null, sha2(text, 256)) sha256", "if(doc_id % 31 = 0, null, n_chars) file_bytes", "if(doc_id % 3 = 0, doc_id * 100, null) id_core",
            "concat('Genus', doc_id % 25, '_species_', 100000 + doc_id, if(doc_id % 2 = 0, concat('_', doc_id % 5), ''), '.jpg') filename", "source scientific_name",
        )

    @cached_property
    def media(self) -> DataFrame:
        a = self.table("benchmark").selectExpr("item_id media_id", "sha2(text, 256) sha256", "concat('file:///', item_id) uri", "case item_id % 4 when 0 then 'CC-BY' when 1 then 'unknown' when 2 then 'restricted' end license")
        return a.unionByName(self.table("documents").selectExpr("1000000 + doc_id media_id", "sha2(if(doc_id % 50 = 7, text, concat(text, '~')), 256) sha256", "concat('file:///d', doc_id) uri", "'all-rights-reserved' license"))

    @cached_property
    def cat(self) -> DataFrame:
        return self.table("part").selectExpr("concat('C', p_partkey) col_id", "if(p_partkey % 3 = 0, upper(p_name), p_name) name", "case p_partkey % 4 when 0 then 'genus' when 1 then null else 'species' end rank", "case p_partkey % 5 when 0 then 'accepted' when 1 then 'synonym' else 'provisionally accepted' end status")

    @cached_property
    def names(self) -> DataFrame:
        return self.table("part").selectExpr("cast(p_partkey as int) taxon_id", "concat(p_name, if(p_partkey % 7 = 0, '  ', ''), if(p_partkey % 11 = 0, ' x', '')) name", "case p_partkey % 3 when 0 then 'genus' when 1 then 'species' end rank")

    @cached_property
    def vern(self) -> DataFrame:
        part = self.table("part")
        a = part.selectExpr("concat('C', p_partkey) col_id", "concat(p_type, ' ', p_size) name", "if(p_size % 3 = 2, 'fra', 'eng') language", "case p_size % 4 when 0 then true when 1 then null else false end preferred")
        return a.unionByName(part.selectExpr("concat('C', p_partkey) col_id", "p_brand name", "'eng' language", "p_size % 2 = 0 preferred"))

    @cached_property
    def xwalk(self) -> DataFrame:
        return self.taxa.where("taxon_id % 3 <> 0").selectExpr("taxon_id", "concat('C', taxon_id % 200) col_id")

    @cached_property
    def cells(self) -> DataFrame:
        parts = self.table("part").selectExpr("cast(p_partkey % 36 as int) ix", "cast(p_partkey div 36 % 18 as int) iy", "if(p_partkey % 29 = 0, -9999, cast(floor(p_retailprice) as int)) elevation")
        return parts.groupBy("ix", "iy").agg(F.max("elevation").alias("elevation"))

    @cached_property
    def wide(self) -> DataFrame:
        """The expanded taxa as a table, as several parts of a plan read it: made once for an application and a folder of tables."""
        key = (self.spark.sparkContext.applicationId, self.dir)
        if key not in _wide:
            _wide[key] = kept(taxonomy.expand(self.taxa))
        return _wide[key]
