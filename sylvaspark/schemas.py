"""Declared schemas of the core tables and the rank table."""

from pyspark.sql import types as T

#: Rank level of each rank name; a smaller level is a finer rank.
RANKS = {
    "class": 50, "complex": 11, "epifamily": 32, "family": 30, "genus": 20, "infraclass": 45, "infraorder": 35, "kingdom": 70, "order": 40, "parvorder": 34.5,
    "phylum": 60, "section": 13, "species": 10, "subclass": 47, "subfamily": 27, "subgenus": 15, "subkingdom": 67, "suborder": 37, "subphylum": 57, "subsection": 12,
    "subspecies": 5, "subterclass": 44, "subtribe": 24, "superclass": 53, "superfamily": 33, "superorder": 43, "supertribe": 26, "tribe": 25, "zoosection": 34, "zoosubsection": 33.5,
}
LEVELS = sorted(RANKS.values())
MAJOR = [x for x in LEVELS if x % 10 == 0]


def slot(level: float) -> str:
    """L10, L33_5, ..."""
    return "L" + f"{level:g}".replace(".", "_")


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in (x.split(":") for x in text.split())])


OBSERVATIONS_R0 = "observation_uuid:string observer_id:int latitude:decimal(15,10) longitude:decimal(15,10) positional_accuracy:int taxon_id:int quality_grade:string observed_on:date"
OBSERVATIONS_R1 = OBSERVATIONS_R0 + " anomaly_score:decimal(15,6)"
OBSERVATIONS_R2 = OBSERVATIONS_R0 + " anomaly_score:decimal(20,6)"
PHOTOS = "photo_uuid:string photo_id:int observation_uuid:string observer_id:int extension:string license:string width:smallint height:smallint position:smallint"
TAXA = "taxon_id:int ancestry:string rank_level:double rank:string name:string active:boolean"
OBSERVERS = "observer_id:int login:string name:string"
MANIFEST = "asset_uuid:string asset_row_uuid:string original_path:string original_filename:string flat_name:string scientific_name_raw:string scientific_name_norm:string rank_guess:string id_core:bigint id_suffix:bigint id_type_guess:string width:int height:int sha256:string phash:string source_tag:string license_guess:string file_bytes:bigint keep_flag:boolean"
DUMPS = {"observations": {"r0": OBSERVATIONS_R0, "r1": OBSERVATIONS_R1, "r2": OBSERVATIONS_R2}, "photos": PHOTOS, "taxa": TAXA, "observers": OBSERVERS}


def dump(table: str, release: str = "r1") -> T.StructType:
    text = DUMPS[table]
    return _struct(text[release] if isinstance(text, dict) else text)
