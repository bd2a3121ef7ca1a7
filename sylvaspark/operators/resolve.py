"""Names and media: crosswalk to a catalogue, homonyms, name resolution, duplicates of media files."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvaspark.functions import scalar
from sylvaspark.plans.scratch import kept


def exact_matches(names: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(taxon_id, col_id, match_type, match_score) by name and rank, then by name for the rest. Null ranks match null ranks. Of several, the
    status that sorts first counts, then the id.

    The catalogue is reduced to the first of each name and rank before names meet it, so a name that is frequent on both sides makes no pairs. Tables that grow
    meet by sorting: small files may hold many rows, which a broadcast would bring to the driver."""
    a = names.select("taxon_id", scalar.normalise_name("name").alias("_name"), F.lower("rank").alias("_rank"))
    b = catalogue.select("col_id", scalar.normalise_name("name").alias("_cname"), F.lower("rank").alias("_crank"), "status")
    first = F.struct(F.isnull("status").alias("_last"), "status", F.isnull("col_id").alias("_none"), "col_id")
    both = b.groupBy("_cname", "_crank").agg(F.min(first).alias("_both"))
    only = both.groupBy(F.col("_cname").alias("_oname")).agg(F.min("_both").alias("_only"))
    hits = a.join(both.hint("merge"), F.col("_name").eqNullSafe(F.col("_cname")) & F.col("_rank").eqNullSafe(F.col("_crank")), "left").select("taxon_id", "_name", "_both")
    hits = hits.join(only.hint("merge"), F.col("_name").eqNullSafe(F.col("_oname")))
    best = F.min(F.struct(F.isnull("_both").alias("_rest"), F.coalesce("_both", "_only").alias("_hit")))
    hits = hits.groupBy("taxon_id").agg(best.alias("_best")).select("taxon_id", "_best._rest", "_best._hit.*")
    suffix = F.when(F.col("status") == "accepted", "accepted").otherwise("other_status")
    return hits.select("taxon_id", "col_id", F.concat(F.when(F.col("_rest"), "exact_name_only_").otherwise("exact_name_rank_"), suffix).alias("match_type"), F.when(F.col("_rest"), 0.95).otherwise(1.0).alias("match_score"))


def _segments(length: str, edits: str, i: str) -> tuple[str, str]:
    """(start, length) of segment i of 0..edits of a text, as SQL: as even as can be, the longer ones last."""
    base, rest = f"({length} div ({edits} + 1))", f"({length} % ({edits} + 1))"
    return f"({i} * {base} + greatest(0, {i} - ({edits} + 1 - {rest})))", f"({base} + if({i} >= {edits} + 1 - {rest}, 1, 0))"


def fuzzy_candidates(names: DataFrame, catalogue: DataFrame, cutoff: float = 90, top: int = 5) -> DataFrame:
    """(taxon_id, col_id, score): the best `top` names of the catalogue with a score of `cutoff` or more, exactly.

    A name of length n differs from a partner by k = n (100 - cutoff) / cutoff edits at most. It is cut to k + 1 segments, one of which every partner holds unchanged, moved
    by no more edits than may lie on either side of it; names meet by the equality of (length, number of the segment, segment) with those pieces of the catalogue's names.

    Distinct names are compared; of one name only the first `top` ids of the catalogue can count, so rows that share names make no pairs."""
    a = names.select("taxon_id", scalar.normalise_name("name").alias("_a")).where("_a <> ''")
    b = catalogue.select("col_id", scalar.normalise_name("name").alias("_b")).where("_b <> ''")

    def first(df: DataFrame, key: str, *order) -> DataFrame:
        return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order, F.asc_nulls_last("col_id")))).where(F.col("_rn") <= top).drop("_rn")

    edits = lambda n: f"cast(floor({n} * {(100 - cutoff) / cutoff} + 1e-9) as int)"
    start, size = _segments("_n", "_k", "_i")
    each = "explode(sequence(0, _k)) _i"
    left = a.select("_a").distinct().selectExpr("*", "length(_a) _n").selectExpr("*", f"{edits('_n')} _k").selectExpr("*", each).selectExpr("_a", "_n", "_i", f"substring(_a, {start} + 1, {size}) _seg")
    lengths = f"explode(sequence(cast(ceil(length(_b) * {cutoff / 100} - 1e-9) as int), cast(floor(length(_b) * {100 / cutoff} + 1e-9) as int))) _n"
    right = b.select("_b").distinct().selectExpr("*", lengths).selectExpr("*", f"{edits('_n')} _k", "length(_b) - _n _d").selectExpr("*", each).selectExpr("*", f"{start} _s", f"{size} _z")
    low, high = "greatest(0, _s - _i, _s + _d - (_k - _i))", "least(length(_b) - _z, _s + _i, _s + _d + (_k - _i))"
    right = right.where(f"{low} <= {high}").selectExpr("_b", "_n", "_i", "_z", f"explode(sequence({low}, {high})) _p").selectExpr("_b", "_n", "_i", "substring(_b, _p + 1, _z) _seg").distinct()
    pairs = left.join(right.hint("merge"), ["_n", "_i", "_seg"]).select("_a", "_b").distinct()
    pairs = pairs.withColumn("score", scalar.similarity("_a", "_b")).where(F.col("score") >= cutoff)
    best = first(pairs.join(first(b, "_b").hint("merge"), "_b"), "_a", F.desc("score")).select("_a", "col_id", "score")
    return first(a.join(best.hint("merge"), "_a"), "taxon_id", F.desc("score")).select("taxon_id", "col_id", "score")


def resolve_homonyms(candidates: DataFrame, own: DataFrame, theirs: DataFrame, least: float = 89) -> DataFrame:
    """One candidate (taxon_id, col_id, score) per taxon. A lone one is a single match; without lineage the highest score counts; else most
    agreement with the lineage (genus 2, family, order, class, phylum 1 each), then the score."""
    good = candidates.where(F.col("score") > least).withColumn("_n", F.count("*").over(Window.partitionBy("taxon_id")))
    a = own.select("taxon_id", *[F.col(c).alias(f"_o_{c}") for c in ("genus", "family", "order", "class", "phylum")])
    b = theirs.select("col_id", *[F.col(c).alias(f"_t_{c}") for c in ("genus", "family", "order", "class", "phylum")])
    points = lambda c, p: F.when(F.lower(f"_o_{c}") == F.lower(f"_t_{c}"), p).otherwise(0)
    s = good.join(a.hint("merge"), "taxon_id", "left").join(b.hint("merge"), "col_id", "left").withColumn("_p", points("genus", 2) + points("family", 1) + points("order", 1) + points("class", 1) + points("phylum", 1))
    known = F.coalesce(*[F.col(f"_o_{c}") for c in ("genus", "family", "order", "class", "phylum")]).isNotNull()
    w = Window.partitionBy("taxon_id").orderBy(F.desc("_p"), F.desc("score"), "col_id")
    kind = F.when(F.col("_n") == 1, "fuzzy_name_single_match").when(~known, "fuzzy_name_highest_score").when(F.col("_p") > 0, "fuzzy_name_with_ancestors").otherwise("fuzzy_name_no_ancestors")
    return s.withColumn("match_type", kind).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("taxon_id", "col_id", "match_type", (F.col("score") / 100).alias("match_score"))


def crosswalk(names: DataFrame, catalogue: DataFrame, own: DataFrame, theirs: DataFrame) -> DataFrame:
    """All of the above in turn: names without an exact match are compared with the accepted names, and those that match none of them with all names. Without
    accepted names there are no fuzzy matches."""
    exact = kept(exact_matches(names, catalogue))
    rest = names.join(exact.select("taxon_id").hint("merge"), "taxon_id", "left_anti")
    accepted = catalogue.where("status = 'accepted'")
    first = kept(fuzzy_candidates(rest, accepted))
    others = rest.join(first.select("taxon_id").hint("merge"), "taxon_id", "left_anti").join(accepted.limit(1).select(F.lit(1).alias("_any")), F.lit(True), "left_semi")
    return exact.unionByName(resolve_homonyms(first.unionByName(fuzzy_candidates(others, catalogue)), own, theirs))


def media_duplicates(manifest: DataFrame, photo_ids: DataFrame, media: DataFrame) -> DataFrame:
    """(row_id, dup_reason, matched_key, keep_flag): known photo id, then known content, then all but the largest file of one content (unknown sizes are 0, ties to
    the least row id). Rows without a content hash are only tested by id."""
    ids = photo_ids.select(F.col("photo_id").alias("id_core"), F.lit(True).alias("_a")).distinct()
    hashes = media.select("sha256", F.lit(True).alias("_b")).distinct()
    m = manifest.join(ids, "id_core", "left").join(hashes, "sha256", "left").withColumn("_c", F.when(F.col("_a"), "photo_id").when(F.col("_b"), "media_sha256"))
    free = F.col("_c").isNull() & F.col("sha256").isNotNull() & (F.col("sha256") != "")
    w = Window.partitionBy("sha256", free).orderBy(F.desc(F.coalesce(F.col("file_bytes"), F.lit(0))), "row_id")
    m = m.withColumn("_rn", F.when(free, F.row_number().over(w)))
    reason = F.coalesce(F.col("_c"), F.when(F.col("_rn") > 1, "sha256_within"))
    key = F.when(reason == "photo_id", F.col("id_core").cast("string")).when(reason.isNotNull(), F.col("sha256"))
    return m.select("row_id", reason.alias("dup_reason"), key.alias("matched_key"), reason.isNull().alias("keep_flag"))


def resolve_names(rows: DataFrame, taxa: DataFrame) -> DataFrame:
    """(row_id, taxon_id, taxonomy_status): active taxa of that name in any case, nearest to the guessed rank level; without a guess the finest, then the
    least id. no_match, exact_match or multiple_match."""
    t = taxa.where("active").select(F.lower("name").alias("_n"), "taxon_id", "rank_level")
    j = rows.withColumn("_n", F.lower("name")).join(t, "_n", "left")
    far = F.when(F.col("rank_guess").isNotNull(), F.abs(F.col("rank_level") - F.col("rank_guess")))
    w = Window.partitionBy("row_id").orderBy(F.asc_nulls_last(far), F.asc_nulls_last("rank_level"), "taxon_id")
    j = j.withColumns({"_rn": F.row_number().over(w), "_c": F.count("taxon_id").over(Window.partitionBy("row_id"))})
    status = F.when(F.col("_c") == 0, "no_match").when(F.col("_c") == 1, "exact_match").otherwise("multiple_match")
    return j.where("_rn = 1").select("row_id", "taxon_id", status.alias("taxonomy_status"))


def observation_key(name: str = "name", id_core: str = "id_core", asset: str = "row_id"):
    """name:<n>|id:<i> where there is an id, else asset:<a>."""
    return F.when(F.col(id_core).isNotNull(), F.concat(F.lit("name:"), F.col(name), F.lit("|id:"), F.col(id_core))).otherwise(F.concat(F.lit("asset:"), F.col(asset)))


def observations_of_media(resolved: DataFrame) -> DataFrame:
    """One observation per key with its commonest taxon (the least of equals); keys without a taxon have none."""
    some = resolved.where("taxon_id is not null").groupBy("obs_key").agg(F.mode("taxon_id", True).alias("taxon_id"))
    return some.select(scalar.uuid5("obs_key").alias("observation_uuid"), "obs_key", "taxon_id", F.lit("research").alias("quality_grade"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and old rows whose key isn't among them."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))
