"""Queries over tables in which names repeat: as their SQL in DuckDB, with no step of more rows than the tables and the result account for."""

import glob

import duckdb
import pytest
from pyspark.sql import functions as F

from sylvaspark.operators import delta, pairs, taxonomy
from sylvaspark.plans import q_domain, q_relational, registry  # noqa: F401
from sylvaspark.plans.roles import Roles
from sylvaspark.streaming import jobs
from tests.test_oracle import DIR, rows

N = 2000  # parts of eight names: 500,000 pairs of equal names


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Parts with few names, some of them near each other, and one key twice."""
    folder = str(tmp_path_factory.mktemp("tables"))
    words = ["crimson anvil", "crimson  Anvik", "pale ring", "pale rinh", "Long copper rivet", "long copper rivets", "x", "hot bolt"]
    name = "CASE i % 8 " + " ".join(f"WHEN {k} THEN '{w}'" for k, w in enumerate(words)) + " END"
    duckdb.sql(f"COPY (SELECT CAST(i + 1 AS BIGINT) AS p_partkey, {name} AS p_name, 'Brand#1' AS p_brand, 'SMALL' AS p_type, CAST(i % 50 AS INTEGER) AS p_size, 9.5 AS p_retailprice FROM range({N}) t(i) UNION ALL SELECT 7, 'pale ring', 'Brand#1', 'SMALL', 1, 9.5) TO '{folder}/part.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture(scope="module")
def unique(tables, tmp_path_factory):
    """The same without the repeated key."""
    folder = str(tmp_path_factory.mktemp("unique"))
    duckdb.sql(f"COPY (SELECT DISTINCT ON (p_partkey) * FROM '{tables}/part.parquet' ORDER BY p_partkey, p_size DESC) TO '{folder}/part.parquet' (FORMAT parquet)")
    return folder


def most_rows(df):
    """The most rows that a step of the plan gave when `df` was last collected."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        found = node.metrics().get("numOutputRows")
        below = node.children()
        return max([found.get().value() if found.isDefined() else 0, *[walk(below.apply(i)) for i in range(below.size())]])

    return walk(df._jdf.queryExecution().executedPlan())


def holds(spark, folder, name, most=None):
    df = registry.queries()[name](spark, folder)
    got = df.toPandas()
    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet'")
    want = c.execute(registry.SQL[name]).df()
    assert len(want) > 0 and rows(got) == rows(want)
    assert most is None or most_rows(df) <= most


def test_ent_01_makes_no_pairs_of_equal_names(spark, tables):
    holds(spark, tables, "ent_01_exact_name_rank", 2 * N)


def test_ent_02_makes_no_pairs_of_equal_names(spark, tables):
    holds(spark, tables, "ent_02_exact_name_only", 2 * N)


def test_ent_03_compares_distinct_names(spark, tables):
    holds(spark, tables, "ent_03_fuzzy", 6 * N)


@pytest.mark.parametrize("name", ["ent_04_homonyms", "flt_30_score_threshold", "jon_15_fuzzy", "srt_05_top5_candidates", "win_08_best_homonym"])
def test_fuzzy_queries_compare_distinct_names(spark, unique, name):
    holds(spark, unique, name, 6 * N)


def test_ent_05_makes_no_pairs_and_broadcasts_no_rows(spark, unique):
    """All but the one row that says whether there are accepted names meets by sorting, as estimates from small files may be far too low."""
    holds(spark, unique, "ent_05_crosswalk", 6 * N)
    plan = registry.queries()["ent_05_crosswalk"](spark, unique)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") > 4


def most_in_a_task(df):
    """The most rows that one partition gives, of how many."""
    n = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in n), sum(r["count"] for r in n)


def test_pairs_of_a_frequent_key_are_spread(spark, monkeypatch):
    """One key on both sides, with repeated rows, and one that no one shares."""
    monkeypatch.setattr(pairs, "BLOCK", 50)
    monkeypatch.setattr(pairs, "PAIRS", 20_000)
    a = spark.range(1000).selectExpr("if(id % 100 = 0, null, 'k') k", "id div 2 x")
    b = spark.range(500).selectExpr("if(id = 7, 'z', 'k') k", "concat('C', id) y")
    out = pairs.pairs(a, b, "k")
    assert out.exceptAll(a.join(b, "k").select(out.columns)).isEmpty()
    most, n = most_in_a_task(out)
    assert n == 990 * 499 and most < n / 4
    assert pairs.pairs(a.limit(0), b, "k").count() == 0


def test_jon_14_spreads_its_pairs(spark, tables, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS", 10_000)
    holds(spark, tables, "jon_14_null_safe_merge")
    most, n = most_in_a_task(registry.queries()["jon_14_null_safe_merge"](spark, tables))
    assert n > 100_000 and most < n / 3


def test_jon_19_spreads_its_pairs(spark, tables, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS", 20_000)
    holds(spark, tables, "jon_19_lower_name")
    most, n = most_in_a_task(registry.queries()["jon_19_lower_name"](spark, tables))
    assert n > 400_000 and most < n / 3


def test_dlt_06_picks_taxa_behind_the_join(spark):
    """A semi-join before it is copied into each part of the unions, and all copies sort their rows in the same tasks."""
    r = Roles(spark, DIR)
    only = r.obs1.select("taxon_id").distinct()
    picked = delta.classify(r.taxa, r.taxa2, only)
    assert picked._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1
    assert registry.queries()["dlt_06_top_changed"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 0
    keep = {t.taxon_id for t in only.collect()}
    assert sorted((t.taxon_id, t.change) for t in picked.collect()) == sorted((t.taxon_id, t.change) for t in delta.classify(r.taxa, r.taxa2).collect() if t.taxon_id in keep)


def test_hie_11_keeps_a_pair_one_row(spark):
    """No row for each slot of a lineage, and repeated pairs count once."""
    df = registry.queries()["hie_11_common_ancestor"](spark, DIR)
    got = df.collect()
    assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
    wide = Roles(spark, DIR).wide
    p = spark.createDataFrame([(g.a, g.b) for g in got[:5]] * 2, "a int, b int")
    assert sorted(taxonomy.common_ancestor(wide, p).collect()) == sorted(got[:5])


def test_str_03_writes_as_many_files_as_rows_have_parts(spark, monkeypatch):
    """Not three files, whose writers read a third of the table each; a batch has more of them instead."""
    seen, drops = [], jobs.drops
    monkeypatch.setattr(jobs, "drops", lambda *a, **k: seen.append(a) or drops(*a, **k))
    for parts, want in ((12, (12, 4)), (1, (3, 1))):
        r = Roles(spark, DIR)
        n = r.obs.count()
        r.obs = r.obs.repartition(parts)
        assert 0 < registry.QUERIES["str_03_resumed_fill"](r).count() <= n
        assert (len(glob.glob(seen[-1][1].removeprefix("file://") + "/*.parquet")), seen[-1][3]) == want


def test_jon_23_spreads_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS", 300)
    most, n = most_in_a_task(registry.queries()["jon_23_range_join"](spark, DIR))
    assert n > 1000 and most < n / 3
