import math
import uuid

import pytest
from pyspark.sql import functions as F

from sylvaspark import registry, schemas
from sylvaspark.functions import scalar
from sylvaspark.operators import annotate, delta, export, geo, numbering, quality, resolve, taxonomy
from sylvaspark.plans.export import PRESETS, ExportSpec, Stages, closure_of, gate_spec


def test_ranks():
    assert len(schemas.LEVELS) == 30 and schemas.slot(33.5) == "L33_5" and schemas.MAJOR == [10, 20, 30, 40, 50, 60, 70]


@pytest.mark.parametrize("level, floor", [(57, 50), (50, 40), (70, 60), (33.5, 30)])
def test_major_floor(level, floor):
    assert registry.major_floor(level) == floor
    assert registry.boundary(level, True) == level


def test_clade_roots_in_all_forms():
    assert registry.roots(registry.CLADES["clade"]["pterygota"]) == [(None, 184884), (None, 418641), (40.0, 48796)]
    assert registry.roots(registry.CLADES["clade"]["pterygota"], True) == [(40.0, 48796)]
    assert registry.roots('"L33_5_taxonID" = 7') == [(33.5, 7)] and registry.roots('"L33_5_taxonID" = 7', True) == []
    assert registry.roots(registry.CLADES["clade"]["vespidae"], True) == []
    assert registry.roots(registry.clade_condition(meta="pta", macro="fungi")) == [(50.0, 47158), (50.0, 47119)]


def test_unknown_names():
    with pytest.raises(KeyError):
        registry.region("Atlantis")
    with pytest.raises(KeyError):
        registry.clade_condition(clade="dragons")
    assert registry.clade_condition(clade="dragons", strict_reference=True) == "TRUE"
    assert registry.Box(462.3, 1, 550.2, 2).normalised().west == pytest.approx(102.3)


TAXA = [
    (1, "", 100.0, "stateofmatter", "Life", True), (10, "1", 70.0, "kingdom", "K", True), (20, "1/10", 40.0, "order", "O", False), (21, "1/10/20", 40.0, "order", "O2", True), (30, "1/10/20/21/999", 20.0, "genus", None, True),
    (40, "1/10/20/21/999/30", 10.0, "species", "S", True), (41, "1/10/20", 10.0, "species", "S2", False), (42, None, 33.5, "zoosubsection", "Z", True), (43, "1/10/42", 10.0, "species", "S3", True),
]


@pytest.fixture(scope="module")
def taxa(spark):
    return spark.createDataFrame(TAXA, "taxon_id int, ancestry string, rank_level double, rank string, name string, active boolean")


def test_expansion_edges(taxa):
    w = {r.taxonID: r for r in taxonomy.expand(taxa).collect()}
    assert set(w) == {1, 10, 21, 30, 40, 42, 43}
    assert w[40].L40_taxonID == 21 and w[40].L40_name == "O2" and w[40].L70_taxonID == 10 and w[40].L20_taxonID is None and w[40].L10_name == "S"
    assert w[42].L33_5_taxonID == 42 and w[43].L33_5_name == "Z"
    assert all(w[1][c] is None for c in taxonomy.SLOT_IDS)
    out = {r.taxonID: r for r in taxonomy.with_immediate_ancestors(taxonomy.expand(taxa)).collect()}
    assert (out[43].immediateAncestor_taxonID, out[43].immediateAncestor_rankLevel, out[43].immediateMajorAncestor_taxonID) == (42, 33.5, 10)
    assert out[10].immediateAncestor_taxonID is None


def test_expansion_shuffles_hits_once(taxa):
    plan = taxonomy.expand(taxa)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "hashpartitioning(taxon_id#" in plan
    assert plan.count("Exchange hashpartitioning(taxon_id") <= 3 and "_level#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_closure_and_independence(spark, taxa):
    wide = taxonomy.expand(taxa)
    gate = spark.createDataFrame([(40,), (43,)], "taxon_id int")
    ids = lambda df: {r[0] for r in df.collect()}
    assert ids(taxonomy.species_of_root(gate, wide, 70, 10)) == {40, 43} and ids(taxonomy.species_of_root(gate, wide, None, 42)) == {43}
    assert ids(taxonomy.closure(gate, wide, 40)) == {40, 43, 42} and ids(taxonomy.closure(gate, wide, 71)) == {40, 43, 42, 21, 10}
    taxonomy.require_independent(wide, [(40.0, 21), (33.5, 42)])
    with pytest.raises(ValueError, match="overlap"):
        taxonomy.require_independent(wide, [(70.0, 10), (40.0, 21)])
    with pytest.raises(ValueError, match="unknown"):
        taxonomy.require_independent(wide, [(70.0, 777)])
    assert ids(closure_of(gate, wide, ExportSpec(condition='"taxonID" = 42', minor_ranks=True))) == {43}
    assert ids(closure_of(gate, wide, ExportSpec(condition='"taxonID" = 42', strict_reference=True))) == set()


def test_grade_modes_with_nulls(spark):
    rows = [("research", 1), ("needs_id", 1), ("needs_id", None), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "quality_grade string, L10_taxonID int")
    keep = {m: [tuple(r) for r in df.where(export.grade_condition(m)).collect()] for m in ("ONLY_RESEARCH", "ALL", "ALL_EXCLUDE_SPECIES_NON_RESEARCH", "ONLY_NONRESEARCH", "ONLY_NONRESEARCH_EXCLUDE_SPECIES")}
    assert keep["ONLY_RESEARCH"] == rows[:1] and keep["ALL"] == rows
    assert keep["ALL_EXCLUDE_SPECIES_NON_RESEARCH"] == [rows[0], rows[2], rows[4]]
    assert keep["ONLY_NONRESEARCH"] == rows[1:3] and keep["ONLY_NONRESEARCH_EXCLUDE_SPECIES"] == rows[2:3]


def test_box_borders(spark):
    box = registry.Box(0, 0, 10, 10)
    df = spark.createDataFrame([(0.0, 5.0), (5.0, 5.0), (None, 5.0)], "longitude double, latitude double")
    assert [r[0] for r in df.select(geo.overlaps(box)).collect()] == [True, True, None]
    assert [r[0] for r in df.select(geo.within(box)).collect()] == [False, True, False]


def test_cap_prefers_the_region(spark):
    rows = [(f"u{i}", 7, i >= 8) for i in range(10)] + [("x", None, False)]
    out = export.capped(spark.createDataFrame(rows, "observation_uuid string, L10_taxonID int, in_region boolean"), 3).collect()
    assert {r.observation_uuid for r in out} >= {"u8", "u9", "x"} and len(out) == 4
    assert [r.rn for r in out if r.L10_taxonID is None] == [None]


def test_cap_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id as string) observation_uuid", "cast(id % 5 as int) L10_taxonID", "true in_region")
    assert "WindowGroupLimit" in export.capped(df, 3)._jdf.queryExecution().executedPlan().toString()


def test_empty_summary(spark):
    df = spark.createDataFrame([], "observation_uuid string, taxon_id int, observer_id int, photo_uuid string")
    r = export.summary(df).first()
    assert (r.n_obs, r.max_photos, r.avg_photos) == (0, 0, "0.00")


def test_stage_is_used_again(spark, tmp_path):
    stages, calls = Stages(spark, f"file://{tmp_path}"), []

    def build(n):
        calls.append(n)
        return spark.range(n)

    spec = gate_spec(PRESETS["pta_mini"])
    assert stages.get("g", spec, lambda: build(3)).count() == 3 and stages.get("g", spec, lambda: build(4)).count() == 3
    assert stages.get("g", spec, lambda: build(5), reuse=False).count() == 5
    assert stages.get("e", spec, lambda: build(0)).count() == 0 and stages.get("e", spec, lambda: build(2)).count() == 2
    assert calls == [3, 5, 0, 2] and gate_spec(PRESETS["standard"]).key() == gate_spec(PRESETS["pta_multiphoto"]).key()


ANN = "annotation_id long, subject_id long, label string, set_id int, source_kind string, review_status string, confidence double, conflict_flag boolean, lifecycle_state string"
EDGE = "superseded_annotation_id long, replacement_annotation_id long"


def test_selector_supersession_and_policies(spark):
    rows = [(1, 1, "apis", 1, "human", "accepted", 0.95, False, "active"), (2, 1, "apis", 1, "model", "accepted", 0.83, False, "active"), (3, 1, "apis", 1, "model", "accepted", 0.97, False, "active"), (4, 1, "apis", 1, "imported_dataset", "accepted", 0.88, False, "active")]
    a, e = spark.createDataFrame(rows, ANN), spark.createDataFrame([(2, 3)], EDGE)
    assert annotate.active(a, e).count() == 3
    best = {p: [r.annotation_id for r in annotate.select_best(a, e, p).collect()] for p in ("human_first", "model_first", "hybrid", "none")}
    assert best == {"human_first": [1], "model_first": [3], "hybrid": [1], "none": []}


def test_selector_scope_comes_before_the_rank(spark):
    rows = [(1, 1, "x", 1, "human", "accepted", 0.61, False, "active"), (2, 1, "x", 2, "human", "accepted", 0.99, False, "active")]
    a, e = spark.createDataFrame(rows, ANN), spark.createDataFrame([], EDGE)
    pick = lambda s: [r.annotation_id for r in annotate.select_best(a, e, "human_first", set_ids=s).collect()]
    assert (pick(None), pick([1]), pick([2])) == ([2], [1], [2])


def test_trust_matrix(spark):
    rows = [("human", "rejected", 1.0, False, 0), ("human", None, None, None, 3), ("human", "accepted", 0.1, True, 0), ("model", "accepted", 0.5, False, 2), ("model", "accepted", 0.49, False, 1), ("model", "unreviewed", 0.9, False, 1), ("imported_dataset", "unreviewed", None, False, 2), ("other", "accepted", 1.0, False, 1)]
    df = spark.createDataFrame(rows, "source_kind string, review_status string, confidence double, conflict_flag boolean, want int")
    assert df.where(annotate.trust_rank() != F.col("want")).count() == 0


def test_constraints(spark):
    df = spark.createDataFrame([(1, "k", None), (1, "k", 5), (2, None, 5), (2, None, 5)], "set_id int, source_annotation_key string, score int")
    assert [tuple(r) for r in quality.duplicates(df, ["set_id", "source_annotation_key"]).collect()] == [(1, "k", 2)]
    assert quality.violations(df, {"score": F.col("score") < 3}).count() == 3
    with pytest.raises(ValueError):
        quality.require_one_value(df, "score", "set_id")
    quality.require_one_value(df, "set_id", "score")


def test_changes(spark):
    s = "taxon_id int, ancestry string, rank_level double, rank string, name string, active boolean"
    a = spark.createDataFrame([(1, "x", 10.0, "species", "n", True), (2, "x", 10.0, "species", None, True), (3, "x", 10.0, "species", "n", False), (4, "x/9", 5.0, "subspecies", "n", True)], s)
    b = spark.createDataFrame([(1, "y", 10.0, "species", "m", True), (2, "x", 10.0, "species", "now", True), (3, "x", 10.0, "species", "n", True), (4, "x/9", 5.0, "subspecies", "n", False), (5, "x", 10.0, "species", "n", True), (9, "x", 10.0, "species", "p", True)], s)
    got = {r.taxon_id: r.change for r in delta.classify(a, b).collect()}
    assert got == {1: "BREAKING_ANCESTRY", 2: "NO_CHANGE", 3: "REACTIVATION", 4: "BREAKING_DEACTIVATION", 5: "NEW", 9: "NEW"}
    with pytest.raises(ValueError, match="BREAKING_ANCESTRY 1"):
        delta.gate(delta.classify(a, b))
    rules = [tuple(r) for r in delta.remap_rules(a, b).collect()]
    assert rules == [(4, 9, "SUBSPECIES_TO_SPECIES", "HIGH")] and delta.remap_rules(a, b, strict_reference=True).count() == 0
    hand = spark.createDataFrame([(4, 1, "HIGH"), (3, 1, "LOW")], "old_id int, new_id int, confidence string")
    assert {r.old_id: r.kind for r in delta.remap_rules(a, b, hand).collect()} == {4: "SUBSPECIES_TO_SPECIES", 3: "BY_HAND"}


def test_scalar_functions(spark):
    df = spark.createDataFrame([("abc",), ("Éa",), ("",)], "x string")
    assert [r[0] for r in df.select(scalar.uuid5("x")).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, x)) for x in ("abc", "Éa", "")]
    h = spark.createDataFrame([("ffffffffffffffff",), ("0x10",), ("0000000000000000a",), ("zz",), (None,)], "x string")
    assert [r[0] for r in h.select(scalar.hex_to_int64("x")).collect()] == [-1, 16, None, None, None]
    names = spark.createDataFrame([("Apis_mellifera_123_4.jpg",), ("Apis_mellifera_123.jpg",), ("img 1234567 and 7654321.jpg",), ("a12.jpg",), ("x.jpg",)], "x string")
    assert [tuple(r) for r in names.select(*scalar.filename_ids("x")).collect()] == [(123, 4, "pattern_id"), (123, None, "pattern_id"), (1234567, None, "extracted_number"), (None, None, "no_id_found"), (None, None, "no_id_found")]
    n = spark.createDataFrame([("  Apis \t  Mellifera ",), (" ",), (None,)], "x string")
    assert [r[0] for r in n.select(scalar.normalise_name("x")).collect()] == ["apis mellifera", "", None]


def test_name_resolution_and_media(spark, taxa):
    rows = spark.createDataFrame([(1, "s", 10.0), (2, "O2", None), (3, "nothing", None), (4, None, 5.0)], "row_id int, name string, rank_guess double")
    assert sorted((r.row_id, r.taxon_id, r.taxonomy_status) for r in resolve.resolve_names(rows, taxa).collect()) == [(1, 40, "exact_match"), (2, 21, "exact_match"), (3, None, "no_match"), (4, None, "no_match")]
    m = spark.createDataFrame([(1, "a", 5, 7), (2, "a", 9, None), (3, "a", 9, None), (4, None, 1, None), (5, None, 1, None), (6, "b", 1, None)], "row_id long, sha256 string, file_bytes long, id_core long")
    out = resolve.media_duplicates(m, spark.createDataFrame([(7,)], "photo_id long"), spark.createDataFrame([("b",)], "sha256 string"))
    assert {r.row_id: (r.dup_reason, r.matched_key) for r in out.collect()} == {1: ("photo_id", "7"), 2: (None, None), 3: ("sha256_within", "a"), 4: (None, None), 5: (None, None), 6: ("media_sha256", "b")}


def test_raster_tiles(spark):
    tiles = spark.createDataFrame([(1, 0.0, 10.0, 1.0, 1.0, 10, 10, -9999.0, [float(i) for i in range(100)]), (2, 10.0, 10.0, 1.0, 1.0, 10, 10, -9999.0, [-9999.0] * 100), (3, 5.0, 10.0, 1.0, 1.0, 10, 10, -9999.0, [500.0] * 100)], "tile_id int, ulx double, uly double, px_w double, px_h double, cols int, rows int, nodata double, values array<double>")
    points = spark.createDataFrame([(0.0, 9.5), (9.99, 0.5), (10.0, 5.0), (19.0, 5.0), (30.0, 5.0), (None, 5.0)], "lon double, lat double")
    assert [r.elevation for r in geo.sample_tiles(points, tiles, 4.0, "lon").orderBy(F.asc_nulls_last("lon")).collect()] == [0.0, 99.0, 500.0, None, None, None]
    assert math.isclose(geo.sample_tiles(points, tiles, 100.0, "lon").agg(F.sum("elevation")).first()[0], 599.0)


def test_fuzzy_candidates_are_those_of_all_pairs(spark):
    """Edits anywhere in the name, the first letter too; lengths that differ; a lower cutoff."""
    import random

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcde ") for _ in range(n)).strip() or "a"
    base = [word(rng.randint(1, 45)) for _ in range(60)]

    def changed(w):
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w) + 1)
            w = rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdxyz") + w[i:], w[:i] + rng.choice("abcdxyz") + w[i + 1 :]))
        return w

    cat = [(f"C{k}", changed(w)) for k, w in enumerate(base * 3)]
    names, catalogue = spark.createDataFrame(list(enumerate(base)), "taxon_id int, name string"), spark.createDataFrame(cat, "col_id string, name string")
    norm = lambda x: " ".join(x.lower().split())
    for cutoff in (90, 75):
        got = {(r.taxon_id, r.col_id): r.score for r in resolve.fuzzy_candidates(names, catalogue, cutoff, 1000).collect()}
        score = lambda a, b: 100 - 100 * edits(a, b) / max(len(a), len(b))
        want = {(i, c): s for i, w in enumerate(base) for c, x in cat if norm(w) and norm(x) and (s := score(norm(w), norm(x))) >= cutoff}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want) and len(want) > 60


def test_crosswalk_falls_back_to_all_names(spark):
    cat = spark.createDataFrame([("C1", "abies alba", "species", "accepted"), ("C2", "picea abies", "species", "synonym"), ("C3", "larix decidua", "species", "synonym"), ("C4", "larix decidue", "species", "accepted")], "col_id string, name string, rank string, status string")
    names = spark.createDataFrame([(1, "abies albb", "species"), (2, "picea abiez", "species"), (3, "larix decidux", "species"), (4, "xxxx", "species")], "taxon_id int, name string, rank string")
    lineage = lambda df, key: df.select(key, *[F.lit(None).cast("string").alias(c) for c in ("genus", "family", "order", "class", "phylum")])
    go = lambda c: {r.taxon_id: r.col_id for r in resolve.crosswalk(names, c, lineage(names, "taxon_id"), lineage(c, "col_id")).collect()}
    assert go(cat) == {1: "C1", 2: "C2", 3: "C4"}
    assert go(cat.where("status <> 'accepted'")) == {}


def test_numbers_in_a_global_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [(r.k, r.rn) for r in numbering.numbered(df, "k").orderBy("k").collect()] == [(i, i + 1) for i in range(1000)]
    out = numbering.batches(df, "k", 300, 700).collect()
    assert sorted((r.k, r.batch) for r in out) == [(i, i // 300) for i in range(700)]
    assert numbering.numbered(df.limit(0), "k").count() == 0


def test_runs(spark):
    steps = [("a", 1, 5, 3, False), ("a", 2, 0, 0, False), ("b", 1, 9, 0, False), ("b", 2, 8, 0, False), ("b", 3, 7, 0, False), ("c", 1, 9, 2, False), ("d", 1, 9, 2, True), ("e", 1, 9, 2, True), ("e", 2, 8, 1, False)]
    out = geo.run_states(spark.createDataFrame(steps, "run string, batch int, remaining int, filled int, error boolean"))
    assert {r.run: (r.state, r.done, r.left) for r in out.collect()} == {"a": ("completed", 3, 0), "b": ("stopped", 0, 7), "c": ("running", 2, 9), "d": ("failed", 2, 9), "e": ("running", 3, 8)}
