"""Scalar functions composed of built-in expressions; nothing here leaves the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sylvaspark import schemas

URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uuid5(name, namespace: str = URL_NAMESPACE) -> Column:
    """Version-5 UUID of a name in a namespace (32 hex digits)."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(_col(name), "UTF-8")))
    variant = F.conv(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8).cast("string"), 10, 16)
    part = lambda at, n: F.substring(h, at, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.lower(variant), part(18, 3)), part(21, 12))


def hex_to_int64(c) -> Column:
    """Signed 64-bit number of up to 16 hex digits, with or without 0x; anything else is null."""
    digits = F.regexp_replace(_col(c), "^0[xX]", "")
    return F.when(digits.rlike("^[0-9a-fA-F]{1,16}$"), F.conv(digits, 16, -10).cast("bigint"))


def safe_int(c) -> Column:
    """Whole number of a text, or null."""
    return F.trim(_col(c)).try_cast("bigint")


def to_bool(c) -> Column:
    """true, 1 and yes (in any case) are true."""
    return F.lower(F.trim(_col(c).cast("string"))).isin("true", "1", "yes")


def normalise_name(c) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), r"\s+", " "))


def regex_int(c, pattern: str) -> Column:
    """First group of a match as a number; null without a match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit("")).try_cast("int")


def spaced(c) -> Column:
    return F.replace(_col(c), F.lit("_"), F.lit(" "))


def rank_guess(c) -> Column:
    """Rank by the number of words: genus, species, subspecies for three and more."""
    n = F.size(F.split(_col(c), " "))
    return F.when(n == 1, "genus").when(n == 2, "species").otherwise("subspecies")


def rank_code_guess(c) -> Column:
    """Rank slot by the number of parts between underscores; four and more are unknown."""
    n = F.size(F.split(_col(c), "_"))
    return F.when(n == 1, "L20").when(n == 2, "L10").when(n == 3, "L5").otherwise("Unknown")


def flat_name(sha256, filename) -> Column:
    """Content hash with the file's extension in lower case."""
    ext = F.regexp_extract(_col(filename), r"(\.[^.]*)$", 1)
    return F.concat(_col(sha256), F.lower(ext))


FILENAME = r"^[A-Z][a-z]+_[A-Za-z_]+_(\d+)(?:_(\d+))?\.jpg$"


def filename_ids(c) -> tuple[Column, Column, Column]:
    """(id, suffix, kind) of a file name: by the pattern, or the first longest run of six digits or more."""
    name = _col(c)
    hit = name.rlike(FILENAME)
    runs = F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1))
    longest = F.array_max(F.transform(runs, lambda x: F.length(x)))
    run = F.element_at(F.filter(runs, lambda x: F.length(x) == longest), 1)
    other = F.size(runs) > 0
    id_core = F.when(hit, F.regexp_extract(name, FILENAME, 1).try_cast("bigint")).when(other & (longest >= 6), F.try_element_at(F.array(run), F.lit(1)).try_cast("bigint"))
    suffix = F.when(hit, F.nullif(F.regexp_extract(name, FILENAME, 2), F.lit("")).try_cast("bigint"))
    return id_core, suffix, F.when(hit, "pattern_id").when(other & (longest >= 6), "extracted_number").otherwise("no_id_found")


def rank_code(c) -> Column:
    """Slot of a rank name."""
    table = F.create_map(*[F.lit(x) for name, level in schemas.RANKS.items() for x in (name, schemas.slot(level))])
    return F.try_element_at(table, _col(c))


def rank_name(c) -> Column:
    table = F.create_map(*[F.lit(x) for name, level in schemas.RANKS.items() for x in (schemas.slot(level), name)])
    return F.try_element_at(table, _col(c))


def similarity(a, b) -> Column:
    """0..100: share of characters that needn't be edited. Stands in for a weighted ratio of an absent library; see the README."""
    longest = F.greatest(F.length(_col(a)), F.length(_col(b)))
    return F.when(longest == 0, F.lit(100.0)).otherwise(F.lit(100.0) - F.lit(100.0) * F.levenshtein(_col(a), _col(b)) / longest)


def media_sidecar(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def zero_based(c) -> Column:
    """photo_3 -> photo_2: a position that starts at one as one that starts at zero."""
    n = F.regexp_extract(_col(c), r"(\d+)$", 1).try_cast("int")
    return F.when(n.isNotNull(), F.concat(F.regexp_replace(_col(c), r"\d+$", ""), (n - 1).cast("string"))).otherwise(_col(c))


def filename_parts(c) -> tuple[Column, Column]:
    """(name, position) of underscored names: all but the last two parts; the last but one if there are five or more."""
    parts = F.split(_col(c), "_")
    n = F.size(parts)
    return F.array_join(F.slice(parts, 1, F.greatest(n - 2, F.lit(0))), " "), F.when(n >= 5, F.get(parts, n - 2))


def major_floor(level: str) -> Column:
    """The major rank below a rank level: 57 -> 50, 50 -> 40."""
    floor = F.floor(F.col(level) / 10) * 10
    return F.when(floor == F.col(level), F.col(level) - 10).otherwise(floor).cast("double")
