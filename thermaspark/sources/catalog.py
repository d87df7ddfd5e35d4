"""Catalogues of products as DataFrames: listing, parsing, filtering, completeness, extents, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STAMP = r"\d{8}T\d{6}"
LEGACY = {f"validation_{long}_{part}": f"validation_{short}" for long, part, short in (("view", "zenith", "vza"), ("view", "azimuth", "vaa"), ("solar", "zenith", "sza"), ("solar", "azimuth", "saa"))}
MATCHUP = "lst_s3hr double, s3_vza double, s3_vaa double, s3_sza double, s3_saa double, validation_lst double, validation_vza double, validation_vaa double, validation_sza double, validation_saa double, land_cover int, s3_time string, validation_cloudmask int"


def list_files(spark: SparkSession, roots: Sequence[str], pattern: str = "*") -> DataFrame:
    """Distinct paths below the roots; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(list(roots)).select("path").distinct()


def parse_stamps(path: Column) -> tuple[Column, Column]:
    """The first two yyyyMMddTHHmmss stamps of a path; both null unless there are two."""
    found = F.regexp_extract_all(path, F.lit(f"({STAMP})"), F.lit(1))
    at = lambda i: F.when(F.size(found) >= 2, F.to_timestamp_ntz(F.get(found, F.lit(i)), F.lit("yyyyMMdd'T'HHmmss")))
    return at(0), at(1)


def scan_catalog(paths: DataFrame) -> DataFrame:
    """path with tile, collection (file-name stem before its stamp), acq_time and day."""
    stamp = F.to_timestamp_ntz(F.nullif(F.regexp_extract("path", f"({STAMP})", 1), F.lit("")), F.lit("yyyyMMdd'T'HHmmss"))
    tile = F.nullif(F.regexp_extract("path", r"/(\d{2}[A-Z]{3})/", 1), F.lit(""))
    stem = F.nullif(F.regexp_extract("path", r"/([^/]*?)_?\d{8}T\d{6}[^/]*$", 1), F.lit(""))
    return paths.select("path", tile.alias("tile"), stem.alias("collection"), stamp.alias("acq_time")).withColumn("day", F.to_date("acq_time"))


def filter_catalog(df: DataFrame, tiles: Sequence[str] | None = None, days: DataFrame | None = None) -> DataFrame:
    out = df.filter(F.col("tile").isin(*tiles)) if tiles else df
    return out.join(days.select("day").distinct(), "day", "left_semi") if days is not None else out


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def missing_days(df: DataFrame, tile: str, start: str, end: str) -> DataFrame:
    """Days from one before start to one after end that the tile has no product of."""
    spark = df.sparkSession
    need = spark.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(start).cast("date"), 1), F.date_add(F.lit(end).cast("date"), 1))).alias("day"))
    return need.join(df.filter(F.col("tile") == tile).select("day").distinct(), "day", "left_anti")


def read_matchups(spark: SparkSession, paths: Sequence[str], legacy: Sequence[str] = ()) -> DataFrame:
    """Match-up CSVs with the fixed columns and src_file; files below `legacy` have older names of four columns."""

    def one(where: Sequence[str], names: dict[str, str]) -> DataFrame:
        back = {v: k for k, v in names.items()}
        raw = spark.read.option("header", "true").csv(list(where))
        have = {c.lower(): c for c in raw.columns}
        fields = [f.split(" ") for f in MATCHUP.split(", ")]
        pick = [F.col(have[back.get(n, n)]).cast(t).alias(n) if back.get(n, n) in have else F.lit(None).cast(t).alias(n) for n, t in fields]
        return raw.select(*pick, F.input_file_name().alias("src_file"))

    parts = [one(p, m) for p, m in ((list(paths), {}), (list(legacy), LEGACY)) if p]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def manifest(products: DataFrame, days: int = 0) -> DataFrame:
    """filename, startTime, endTime (start plus `days`), description; write_manifest() writes it."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.col("acq_time") + F.expr(f"INTERVAL {int(days)} DAY")
    return products.select(F.lit("").alias("geometry"), stamp(F.col("acq_time")).alias("startTime"), stamp(end).alias("endTime"), F.element_at(F.split("path", "/"), -1).alias("filename"), "description")


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.option("sep", ";").option("header", "true").csv(path)


def resolve_extent(tiles: DataFrame, tile: str) -> DataFrame:
    """Bounds of a tile; an unknown one is an error."""
    found = tiles.filter(F.col("tile") == tile).agg(*(F.max(c).alias(c) for c in ("minx", "miny", "maxx", "maxy")))
    return found.select(F.lit(tile).alias("tile"), *(F.coalesce(F.col(c), F.raise_error(F.lit(f"unknown tile {tile}")).cast("double")).alias(c) for c in ("minx", "miny", "maxx", "maxy")))


def polygon_bounds(polygons: DataFrame, vertices: str = "vertices", buffer: float = 0.0) -> DataFrame:
    v = polygons.select(F.explode(vertices).alias("v"))
    return v.agg((F.min("v.x") - buffer).alias("minx"), (F.min("v.y") - buffer).alias("miny"), (F.max("v.x") + buffer).alias("maxx"), (F.max("v.y") + buffer).alias("maxy"))


def pending(expected: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(done.select(*keys).distinct(), list(keys), "left_anti")


def stack_bands(long: DataFrame, keys: Sequence[str], bands: Sequence[str], band: str = "band", value: str = "value") -> DataFrame:
    return long.groupBy(*keys).pivot(band, list(bands)).agg(F.first(value))


def split_bands(wide: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(keys), list(bands), "band", "value")


def cube_to_cells(df: DataFrame, x0: float, dx: float, y0: float, dy: float) -> DataFrame:
    """Nested rows (acq_time, values array<array<double>>) to cells with centre coordinates."""
    rows = df.select("acq_time", F.posexplode("values").alias("row", "line")).select("acq_time", "row", F.posexplode("line").alias("col", "value"))
    return rows.withColumns({"x": x0 + (F.col("col") + 0.5) * dx, "y": y0 + (F.col("row") + 0.5) * dy})


def filter_scenes(cells: DataFrame, scenes: DataFrame, max_cloud: float = 95.0, key: str = "acq_id") -> DataFrame:
    return cells.join(scenes.filter(F.col("cloud_cover") <= max_cloud).select(key), key, "left_semi")


def missing_products(candidates: DataFrame, imported: DataFrame, kinds: Sequence[str], name: str = "name") -> DataFrame:
    wanted = F.lit(False)
    for k in kinds:
        wanted = wanted | F.contains(F.col(name), F.lit(k))
    return candidates.filter(wanted).join(imported.select(name).distinct(), name, "left_anti")


def platform(name: Column) -> Column:
    up = F.upper(F.trim(name))
    return F.when(up.rlike(r"^(L|LANDSAT[- ]?)8$"), "LANDSAT-8").when(up.rlike(r"^(L|LANDSAT[- ]?)9$"), "LANDSAT-9").otherwise(up)


def find_scenes(bounds: DataFrame, scenes: DataFrame) -> DataFrame:
    """bounds(day, platform, minx..maxy) meet scenes of the same day and platform whose box intersects theirs."""
    a = bounds.withColumn("platform", platform(F.col("platform"))).alias("a")
    b = scenes.withColumn("platform", platform(F.col("platform"))).alias("b")
    hit = (F.col("a.minx") <= F.col("b.maxx")) & (F.col("a.maxx") >= F.col("b.minx")) & (F.col("a.miny") <= F.col("b.maxy")) & (F.col("a.maxy") >= F.col("b.miny"))
    return a.join(b, (F.col("a.day") == F.col("b.day")) & (F.col("a.platform") == F.col("b.platform")) & hit)


def series(values: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Values numbered in time order."""
    return values.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(time)))
