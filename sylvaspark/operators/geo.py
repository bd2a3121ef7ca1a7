"""Boxes, raster look-ups by grid key, and the elevation fill."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvaspark.registry import Box


def overlaps(box: Box, lon: str = "longitude", lat: str = "latitude") -> Column:
    """Border included."""
    return F.col(lon).between(box.west, box.east) & F.col(lat).between(box.south, box.north)


def within(box: Box, lon: str = "longitude", lat: str = "latitude") -> Column:
    """Border left out; a null position is outside."""
    return F.coalesce((F.col(lon) > box.west) & (F.col(lon) < box.east) & (F.col(lat) > box.south) & (F.col(lat) < box.north), F.lit(False))


def with_point(df: DataFrame) -> DataFrame:
    """lon and lat as doubles; both null unless both are known."""
    known = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    return df.withColumns({"lon": F.when(known, F.col("longitude").cast("double")), "lat": F.when(known, F.col("latitude").cast("double"))})


def sample_grid(points: DataFrame, cells: DataFrame, lon0: int, lat0: int, size: int, nodata: int = -9999) -> DataFrame:
    """Points with `elevation` of their grid cell (ix, iy, elevation), by equality of the cell key. Cells are half-open, so a point is in one; nodata is null;
    of several values for one cell the least counts."""
    grid = cells.where(F.col("elevation") != nodata).groupBy("ix", "iy").agg(F.min("elevation").alias("elevation"))
    ix, iy = F.floor((F.col("longitude") - lon0) / size).cast("int"), F.floor((F.col("latitude") - lat0) / size).cast("int")
    return points.withColumns({"ix": ix, "iy": iy}).join(grid, ["ix", "iy"], "left").drop("ix", "iy")


def sample_tiles(points: DataFrame, tiles: DataFrame, span: float, key: str) -> DataFrame:
    """Points (lon, lat, and a unique key) with `elevation` from tiles (tile_id, ulx, uly, px_w, px_h, cols, rows, nodata, values). Tiles and points meet by the `span`-degree grid
    cell; a tile is in all the cells that it touches. On overlap the least tile_id that has a value counts."""
    cells = lambda lo, hi: F.sequence(F.floor(lo / span), F.floor(hi / span))
    t = tiles.withColumns({"_e": F.col("ulx") + F.col("px_w") * F.col("cols"), "_s": F.col("uly") - F.col("px_h") * F.col("rows")})
    t = t.withColumn("_gx", F.explode(cells(F.col("ulx"), F.col("_e")))).withColumn("_gy", F.explode(cells(F.col("_s"), F.col("uly"))))
    p = points.withColumns({"_gx": F.floor(F.col("lon") / span), "_gy": F.floor(F.col("lat") / span)})
    col, row = F.floor((F.col("lon") - F.col("ulx")) / F.col("px_w")).cast("int"), F.floor((F.col("uly") - F.col("lat")) / F.col("px_h")).cast("int")
    hit = p.select(key, "lon", "lat", "_gx", "_gy").join(t, ["_gx", "_gy"]).withColumns({"_c": col, "_r": row}).where("_c >= 0 and _c < cols and _r >= 0 and _r < rows")
    hit = hit.withColumn("_v", F.get(F.col("values"), F.col("_r") * F.col("cols") + F.col("_c"))).where("_v is not null and _v <> nodata")
    best = hit.groupBy(key).agg(F.min_by("_v", "tile_id").cast("double").alias("elevation"))
    return points.join(best, key, "left").select(*points.columns, "elevation")


def fill(points: DataFrame, sampled: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(filled, excluded): points that lacked an elevation and got one; those that got none, with the reason."""
    lacking = sampled.join(points.where("elevation is null and longitude is not null and latitude is not null").select(key), key, "left_semi")
    return lacking.where("elevation is not null"), lacking.where("elevation is null").withColumn("reason", F.lit("no_raster_value"))


def coverage(df: DataFrame) -> DataFrame:
    null, placed = F.col("elevation").isNull(), F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    return df.agg(F.count("*").alias("total"), F.count_if(null).alias("no_elevation"), F.count_if(null & placed).alias("fillable"), F.count_if(null & ~placed).alias("unplaced"))


#: What a run may go to from each of its states.
RUN_STATES = {"running": {"completed", "failed", "stopped"}, "stopped": {"running"}, "failed": {"running"}, "completed": set()}


def run_states(steps: DataFrame, stop_after: int = 3) -> DataFrame:
    """(run, state, done, left) of runs from their batches (run, remaining, filled, error): a run without batches left is completed; one whose last batch broke has failed; one whose
    last `stop_after` batches filled nothing is stopped, as more of them would fill nothing either; all others are running. Batches come in the order of `batch`."""
    last = Window.partitionBy("run").orderBy(F.desc("batch"))
    s = steps.withColumn("_k", F.row_number().over(last))
    s = s.groupBy("run").agg(F.min_by("remaining", "_k").alias("left"), F.min_by("error", "_k").alias("_error"), F.sum("filled").alias("done"), F.sum(F.when(F.col("_k") <= stop_after, F.col("filled"))).alias("_recent"), F.count("*").alias("_n"))
    state = F.when(F.col("_error"), "failed").when(F.col("left") == 0, "completed").when((F.col("_recent") == 0) & (F.col("_n") >= stop_after), "stopped").otherwise("running")
    return s.select("run", state.alias("state"), "done", "left")


def payload_rules() -> dict[str, Column]:
    """Validation of annotation geometry, normalised to [0, 1]: a rule holds where it isn't false."""
    unit = lambda c: F.col(c).between(0, 1)
    kind = F.col("geometry_kind")
    return {
        "kind": kind.isin("whole", "bbox", "polygon", "mask", "point"),
        "bbox_unit": unit("bbox_x_min") & unit("bbox_y_min") & unit("bbox_x_max") & unit("bbox_y_max"),
        "bbox_order": (F.col("bbox_x_min") < F.col("bbox_x_max")) & (F.col("bbox_y_min") < F.col("bbox_y_max")),
        "bbox_complete": (kind != "bbox") | (F.col("bbox_x_min").isNotNull() & F.col("bbox_y_min").isNotNull() & F.col("bbox_x_max").isNotNull() & F.col("bbox_y_max").isNotNull()),
        "point_complete": (kind != "point") | (F.col("point_x").isNotNull() & F.col("point_y").isNotNull()),
    }
