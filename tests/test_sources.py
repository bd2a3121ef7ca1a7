import pytest
from pyspark.sql import functions as F

from sylvaspark import schemas
from sylvaspark.operators import quality
from sylvaspark.sources import files, sinks
from sylvaspark.streaming import jobs


def test_dump_keeps_quotes_and_nulls(spark, tmp_path):
    p = tmp_path / "taxa.csv"
    p.write_text('taxon_id\tancestry\trank_level\trank\tname\tactive\n1\t\t10\tspecies\tThe "blue" one\ttrue\n2\t1/2\t33.5\t\t\tfalse\n')
    a, b = files.dump(spark, str(p), "taxa").orderBy("taxon_id").collect()
    assert a.name == 'The "blue" one' and a.ancestry is None and b.rank_level == 33.5 and b.name is None and not b.active
    p.write_text("taxon_id\tancestry\trank_level\trank\tname\tactive\nx\t\t10\tspecies\tn\ttrue\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILFAST"):
        files.dump(spark, str(p), "taxa").collect()


def test_release_needs_all_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.release(spark, str(tmp_path))


def test_overflowing_decimal_is_noticed(spark, tmp_path):
    p = tmp_path / "o.csv"
    p.write_text("v\n1.5\n99999999999999999999\n")
    raw, typed = spark.read.csv(str(p), header=True), spark.read.csv(str(p), header=True, schema="v decimal(10,2)")
    with pytest.raises(ValueError, match="1 values of v"):
        quality.require_no_nulls_from_cast(raw, typed, "v")


def test_catalogue(spark, tmp_path):
    p = tmp_path / "VernacularName.tsv"
    p.write_text('col:taxonID\tcol:name\tcol:country\tcol:preferred\nA\tbee "x\tNA\ttrue\nB\t\tFR\t\n')
    out = files.catalogue(spark, str(p), booleans=["preferred"]).orderBy("taxonID").collect()
    assert [tuple(r) for r in out] == [("A", 'bee "x', None, True), ("B", None, "FR", None)]
    assert set(files.CATALOGUE_FILES) == {"name_usage_staging", "vernacular_name", "distribution", "media", "reference", "type_material"}


def test_images_and_links(spark, tmp_path):
    (tmp_path / "in" / "Apis").mkdir(parents=True)
    (tmp_path / "out").mkdir()
    (tmp_path / "in" / "Apis" / "Apis_mellifera_1.jpg").write_bytes(b"abc")
    (tmp_path / "in" / "Apis" / "notes.txt").write_text("no")
    df = files.images(spark, str(tmp_path / "in"))
    r = df.first()
    assert df.count() == 1 and (r.filename, r.folder, r.bytes) == ("Apis_mellifera_1.jpg", "Apis", 3) and r.sha256.startswith("ba7816bf")
    flat = df.select("path", F.concat("sha256", F.lit(".jpg")).alias("flat_name"))
    assert [x.result for x in sinks.materialise_files(flat, str(tmp_path / "out")).collect()] == ["linked"]
    assert [x.result for x in sinks.materialise_files(flat, str(tmp_path / "out")).collect()] == ["present"]


def test_ascii_grids(spark, tmp_path):
    (tmp_path / "a.asc").write_text("ncols 3\nnrows 2\nxllcorner 10\nyllcorner 20\ncellsize 0.5\nNODATA_value -9999\n1 2 3\n4 5 -9999\n")
    tiles = sorted(files.ascii_grids(spark, str(tmp_path), tile=2).collect(), key=lambda t: t.ulx)
    assert [(t.ulx, t.uly, t.cols, t.rows, list(t["values"])) for t in tiles] == [(10.0, 21.0, 2, 2, [1.0, 2.0, 4.0, 5.0]), (11.0, 21.0, 1, 2, [3.0, -9999.0])]


def test_sorted_export_is_sorted(spark, tmp_path):
    sinks.sorted_tsv(spark.range(100).select((99 - F.col("id")).alias("id"), F.lit(None).cast("string").alias("x")), str(tmp_path / "o"), "id", single_file=True)
    (part,) = (tmp_path / "o").glob("part-*")
    lines = part.read_text().splitlines()
    assert lines[0] == "id\tx" and [int(x.split("\t")[0]) for x in lines[1:]] == list(range(100))


def test_counts_and_text(spark):
    assert sinks.verify_counts(a=spark.range(3), b=spark.range(3)) == 3
    with pytest.raises(ValueError):
        sinks.verify_counts(a=spark.range(3), b=spark.range(4))
    assert sinks.summary_text(spark.range(3).agg(F.count("*").alias("n")), region="NAfull") == "region: NAfull\nn: 3"


def test_first_spelling(spark):
    df = spark.createDataFrame([(1,)], "taxonID int")
    assert files.first_of(df, "taxon_id", "taxonID") == "taxonID"
    with pytest.raises(KeyError):
        files.first_of(df, "x")


def test_schemas():
    assert [f.name for f in schemas.dump("observations", "r1")][-1] == "anomaly_score"
    assert schemas.dump("observations", "r2")["anomaly_score"].dataType.precision == 20


def test_stream_resumes(spark, tmp_path):
    folder, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.range(5).write.parquet(folder)
    merge = jobs.upsert_into(target, "id")
    for n in (5, 8):
        spark.range(n).write.mode("append").parquet(folder)
        jobs.run_available(jobs.drops(spark, folder, "id long"), merge, mark)
        assert spark.read.parquet(target).count() == n
