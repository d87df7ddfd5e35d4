"""Registered queries of the products, of steps that earlier queries leave out, and their DuckDB equivalents."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..fixtures import fixture
from ..functions import bands as B
from ..operators import analysis as H
from ..operators import grid as G
from ..operators import mask as C
from ..operators import matchup as M
from ..operators import sharpen as I
from ..operators import swath as S
from ..operators import temporal as E
from ..operators import windows as W
from ..sources import catalog as A
from ..sources.staging import shared_dir, staged
from . import pipelines as K
from . import preprocess as PP
from . import products as X
from .catalogue import AIR, DATED, DEM, MEDIANS, OBS, ORACLES, SESA, dated_features, filled_sql, observations, paired_temperature, query, r6, rounded, scene_pairs, spline_sql


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def sql_to_utm(lon: str, lat: str, epsg: int) -> tuple[str, str]:
    meridian, north = G.utm_zone(epsg)
    k = 2 * G.N3**0.5 / (1 + G.N3)
    s = f"SIN(RADIANS({lat}))"
    t = f"SINH(ATANH({s})-{k!r}::DOUBLE*ATANH({k!r}::DOUBLE*{s}))"
    dl = f"RADIANS({lon}-({meridian}::DOUBLE))"
    xi, eta = f"ATAN2({t},COS({dl}))", f"ATANH(SIN({dl})/SQRT(1+({t})*({t})))"
    x = "+".join([eta, *(f"{a!r}::DOUBLE*COS({2 * j}*{xi})*SINH({2 * j}*{eta})" for j, a in enumerate(G.ALPHA, 1))])
    y = "+".join([xi, *(f"{a!r}::DOUBLE*SIN({2 * j}*{xi})*COSH({2 * j}*{eta})" for j, a in enumerate(G.ALPHA, 1))])
    m = G.SCALE * G.RECTIFYING
    return f"{G.EAST}::DOUBLE+{m!r}::DOUBLE*({x})", f"{north}::DOUBLE+{m!r}::DOUBLE*({y})"


@query("SELECT px_id, ROUND({}, 3) AS x, ROUND({}, 3) AS y FROM swath".format(*sql_to_utm("lon", "lat", 32735)), "swath")
def b3_to_utm(spark, d):
    """Coordinates themselves; b3_reproject_round_trip has the way there and back."""
    x, y = G.reproject(F.col("lon"), F.col("lat"), 4326, 32735)
    return fixture(spark, d, "swath").select("px_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '2000-01-01'")
def a1_read_cells(spark, d):
    return X.read_cells(spark, f"{d}/lineitem.parquet", ["l_quantity", "l_discount"], ["l_orderkey", "l_linenumber"], "R", "1998-01-01", "1999-12-31", "l_returnflag", "l_shipdate")


SEEDS = (1, 2, 3)


@query("SELECT sample_id, s3_time, CASE WHEN COUNT(*)<200 THEN COUNT(*) ELSE CAST(FLOOR((CASE WHEN COUNT(*)<=200 THEN 1.0/200 ELSE (1+LOG10(COUNT(*)/200.0))/COUNT(*) END)*200*COUNT(*)) AS BIGINT) END AS n FROM matchup, (SELECT unnest([1, 2, 3]) AS sample_id) GROUP BY 1, 2", "matchup")
def a11_sample_sizes(spark, d):
    m = fixture(spark, d, "matchup")
    return X.samples(m, m.columns, SEEDS, 200).groupBy("sample_id", "s3_time").agg(F.count("*").alias("n"))


@query("SELECT acq_id, ROUND(-15.0e0-0.01e0*MIN(row_lr), 6) AS top, ROUND(25.0e0+0.01e0*(MAX(col_lr)+1), 6) AS \"right\", ROUND(-15.0e0-0.01e0*(MAX(row_lr)+1), 6) AS bottom, ROUND(25.0e0+0.01e0*MIN(col_lr), 6) AS \"left\" FROM s3_obs GROUP BY 1", "s3_obs")
def a15_acquisition_bounds(spark, d):
    cells = fixture(spark, d, "s3_obs").select("acq_id", F.col("row_lr").alias("row"), F.col("col_lr").alias("col"))
    return rounded(X.acquisition_bounds(cells, G.Grid(25.0, 0.01, -15.0, -0.01, 10, 10), 4326, ["acq_id"]))


@query("SELECT DISTINCT acq_id, CAST(FLOOR(acq_id/2) AS BIGINT) AS minx FROM s3_obs WHERE acq_id % 3 <> 0", "s3_obs")
def a16_pending_extents(spark, d):
    every = fixture(spark, d, "s3_obs").select("acq_id", F.floor(F.col("acq_id") / 2).alias("minx")).distinct()
    return X.pending(every, every.filter("acq_id % 3 = 0"), ["acq_id"], ["minx"])


@query("SELECT acq_date, row_hr, col_hr, b04, b08 FROM s2_obs", "s2_obs")
def a20_keep_required_bands(spark, d):
    return X.keep_required_bands(fixture(spark, d, "s2_obs"), "s2", ["acq_date", "row_hr", "col_hr"])


@query("SELECT event_type || '_' || event_id AS name FROM events WHERE event_type IN ('view', 'click') AND event_id % 3 <> 0")
def a21_missing_granules(spark, d):
    names = table(spark, d, "events").select(F.concat_ws("_", "event_type", "event_id").alias("name"), "event_id")
    return A.missing_products(names, names.filter("event_id % 3 = 0"), ["view", "click"]).select("name")


@query("SELECT acq_date, row_hr, col_hr, CASE WHEN scl <> 3 THEN b04 END AS b04 FROM s2_obs", "s2_obs")
def c7_mask(spark, d):
    return C.mask(fixture(spark, d, "s2_obs"), F.col("scl") == 3, ["b04"]).select("acq_date", "row_hr", "col_hr", "b04")


@query("SELECT event_id FROM events WHERE event_type <> 'error'")
def c10_corrected_orbits(spark, d):
    marked = table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "error", "False").when(F.col("event_type") == "view", "True").alias("OrbitCorrectionPerformed"))
    return C.corrected_orbits(marked).select("event_id")


@query(DEM + " SELECT CAST(row*3+i AS INT) AS row, CAST(col*3+j AS INT) AS col, alt FROM c, range(3) a(i), range(3) b(j)", "dem")
def d4_resample_to_20_m(spark, d):
    cells, source = heights(spark, d)
    return X.resample_to(cells, ["alt"], source, 20.0)


def heights(spark, d):
    """Cells of 60 m and their grid."""
    cells = fixture(spark, d, "dem").select(F.col("row_hr").alias("row"), F.col("col_hr").alias("col"), "alt")
    rows, cols = cells.agg(F.max("row") + 1, F.max("col") + 1).first()
    return cells, G.Grid(0, 60.0, 0, -60.0, cols, rows)


@query("SELECT a.event_id AS left_id, b.event_id AS right_id FROM events a JOIN events b ON a.event_type='error' AND b.event_type='view' AND ABS(epoch_us(a.ts)-epoch_us(b.ts)) < 600000000")
def e5_simultaneous_events(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    side = lambda kind, n: e.filter(F.col("event_type") == kind).select(F.col("event_id").alias(f"{n}_id"), F.col("ts").alias(f"{n}_time"))
    return E.simultaneous(side("error", "left"), side("view", "right"), 10, left_time="left_time", right_time="right_time").select("left_id", "right_id")


@query("SELECT 'E_' || a.event_id || '.tif' AS validation_name, 'S3_' || b.event_id || '.tif' AS s3_name, 'upscaled_S3_' || b.event_id || '_to_val_E_' || a.event_id || '.tif' AS out_name FROM events a JOIN events b ON a.event_type='error' AND b.event_type='view' AND ABS(epoch_us(a.ts)-epoch_us(b.ts)) < 600000000")
def e7_validation_pairs(spark, d):
    e = table(spark, d, "events").withColumn("time", F.col("ts").cast("timestamp_ntz"))
    side = lambda kind, head: e.filter(F.col("event_type") == kind).select(F.concat(F.lit(head), F.col("event_id"), F.lit(".tif")).alias("name"), "time")
    return X.validation_pairs(side("error", "E_"), side("view", "S3_"), "val").select("validation_name", "s3_name", "out_name")


@query("SELECT px_id, CASE WHEN MOD(px_id,10)=0 OR MOD(px_id,7)=0 THEN -999 ELSE CAST(TRUNC((TRUNC(lst/0.01e0)*0.01e0-(280.0e0+MOD(px_id,200)/10.0e0))/0.01e0) AS INT) END AS lst_ta FROM s3_obs", "s3_obs")
def f12_stored_difference(spark, d):
    stored = F.when(F.col("px_id") % 10 == 0, 0).otherwise(B.encoded(F.col("lst"), B.band("S3-LST")))
    ta = F.when(F.col("px_id") % 7 != 0, 280.0 + (F.col("px_id") % 200) / 10.0)
    return fixture(spark, d, "s3_obs").select("px_id", X.stored_difference(stored, ta).cast("int").alias("lst_ta"))


@query(
    f"""+ a AS (SELECT acq_id AS pair_id, acq_id % 3 AS tile, row_lr AS row, col_lr AS col, lst, vza, vaa FROM s3_obs), b AS (SELECT acq_id-1 AS pair_id, (acq_id-1) % 3 AS tile, row_lr AS row, col_lr AS col, lst, vza, vaa FROM s3_obs)
SELECT CAST(tile AS VARCHAR) AS tile, pair_id, row, col, ROUND(a.lst,6) AS lst_s3hr, ROUND(b.lst,6) AS validation_lst, ROUND(a.lst-b.lst,6) AS difference,
 ROUND({SESA.format(a='a.vza', b='b.vza', c='a.vaa', d='b.vaa')},4) AS sesa FROM a JOIN b USING (tile, pair_id, row, col) WHERE a.lst<>0 AND b.lst<>0 AND pair_id % 4 <> 0""",
    "s3_obs",
)
def g3_compare_tiles(spark, d):
    s3 = fixture(spark, d, "s3_obs").select(F.col("acq_id").alias("pair_id"), F.col("row_lr").alias("row"), F.col("col_lr").alias("col"), "lst", "vza", "vaa", "sza", "saa", "acq_time", "confidence_in")
    tile = (F.col("pair_id") % 3).cast("string")
    val = s3.select("*", C.flag(F.col("confidence_in"), "summary_cloud").alias("cloudmask"), F.lit(1.0).alias("land_fraction")).withColumn("pair_id", F.col("pair_id") - 1).withColumn("tile", tile)
    cover = s3.select("row", "col", F.lit(10).alias("land_cover")).distinct()
    s3 = s3.withColumn("tile", tile)
    out = X.compare_tiles(s3, val, cover, s3.filter("pair_id % 4 = 0").select("tile", "pair_id").distinct())
    return rounded(out.select("tile", "pair_id", "row", "col", "lst_s3hr", "validation_lst", "difference")).join(out.select("tile", "pair_id", "row", "col", F.round("sesa", 4).alias("sesa")), ["tile", "pair_id", "row", "col"])


def scenes(spark, d):
    return dated_features(spark, d).join(scene_pairs(spark, d), "acq_date"), paired_temperature(spark, d)


@query()
def i5_plain_tree(spark, d):
    fine, low = scenes(spark, d)
    return X.sharpen_scenes(fine, low, ["b04", "b08"], 2, ["acq_date", "day"], plain=True)[0]


@query()
def i8_sharpen_scenes(spark, d):
    """A model for each scene, all grown in the same jobs, with the correction by residuals."""
    fine, low = scenes(spark, d)
    return X.sharpen_scenes(fine, low, ["b04", "b08"], 2, ["acq_date", "day"], residual=True)[0]


@query(DATED + ", m AS (SELECT acq_date, CAST(FLOOR(row/2) AS INT) AS row, CAST(FLOOR(col/2) AS INT) AS col, AVG(b04) AS b04, STDDEV_POP(b04) AS s04, AVG(b08) AS b08, STDDEV_POP(b08) AS s08 FROM fine GROUP BY 1, 2, 3), k AS (SELECT acq_date, day, (s04/b04+s08/b08)/2 AS cv FROM m JOIN pairs USING (acq_date) JOIN low USING (day, row, col)) SELECT acq_date, day, COUNT(*) FILTER (cv > 0 AND cv < 0.15) AS n, COUNT(*) FILTER (cv > 0 AND cv < 0.15) > 0 AS usable FROM pairs LEFT JOIN k USING (acq_date, day) GROUP BY 1, 2", "s2_obs s3_obs")
def i8_usable_scenes(spark, d):
    """Scenes with the number of cells that train them, at a threshold that leaves some scenes without any."""
    fine, low = scenes(spark, d)
    got = I.training_samples(fine, low, ["b04", "b08"], 2, 0.15, ["acq_date", "day"])
    return I.trained_scenes(fine, got, ["acq_date", "day"])


@query(
    DEM + """, s AS (SELECT c.row, c.col, COUNT(*) AS n, SUM(dc*(2-ABS(dr))*x.alt)/(8*60.0) AS gx, SUM(dr*(2-ABS(dc))*x.alt)/(8*60.0) AS gy FROM c, range(-1, 2) p(dr), range(-1, 2) q(dc), c x WHERE x.row=c.row+dr AND x.col=c.col+dc GROUP BY 1, 2),
t AS (SELECT row, col, CASE WHEN n=9 THEN ROUND(SQRT(gx*gx+gy*gy), 6) END AS slope, CASE WHEN n=9 AND (gx<>0 OR gy<>0) THEN ROUND(CASE WHEN ATAN2(-gx,gy)<0 THEN ATAN2(-gx,gy)+2*PI() ELSE ATAN2(-gx,gy) END, 6) END AS aspect FROM s)
SELECT CAST(row*3+i AS INT) AS row, CAST(col*3+j AS INT) AS col, alt, slope, aspect FROM c JOIN t USING (row, col), range(3) a(i), range(3) b(j)""",
    "dem",
)
def k3_prepare_dem(spark, d):
    cells, source = heights(spark, d)
    return rounded(X.prepare_dem(cells.unionByName(cells.withColumn("alt", F.col("alt") - 5)), source))


@query(
    OBS + ", " + AIR.removeprefix("+ ").replace("FROM era5_hourly", "FROM i") .replace("v AS (SELECT", "i AS (SELECT f.cell_id, acq_time, x.t2m*frac+y.t2m*(1-frac) AS t2m, x.d2m*frac+y.d2m*(1-frac) AS d2m, x.sp*frac+y.sp*(1-frac) AS sp, x.z*frac+y.z*(1-frac) AS z FROM f JOIN era5_hourly x ON x.cell_id=f.cell_id AND x.valid_time=b JOIN era5_hourly y ON y.cell_id=f.cell_id AND y.valid_time=a), v AS (SELECT", 1)
    + """, t AS (SELECT *, t2m-lapse*(0-(z/9.80665+2)) AS td FROM g), m AS (SELECT *, 1e6*(2.501-2.361e-3*(td-273.15)) AS lt FROM t)
SELECT cell_id, acq_time, ROUND(t2m,6) AS t2m, ROUND(td,6) AS t_datum, ROUND(td - 9.8*(287.04*td*td+lt*r*td)/(cp*287.04*td*td+lt*lt*r*0.622)*1100.0, 6) AS air_temperature FROM m""",
    "s3_obs era5_hourly",
)
def k5_era5_at(spark, d):
    """At all observations, with the air temperature above the ground."""
    obs = observations(spark, d).withColumn("elev", F.lit(1000.0))
    return rounded(K.era5_at(obs, fixture(spark, d, "era5_hourly"), "elev").select("cell_id", "acq_time", "t2m", "t_datum", "air_temperature"))


@query()
def k6_lst_ta_product(spark, d):
    """The whole product with sharpening and corrections; minimum_slice is its daily mean without sharpening."""
    s3, cell = fixture(spark, d, "s3_obs"), (F.floor(F.col("row") / 10) * 2 + F.floor(F.col("col") / 10)).cast("int")
    return X.lst_ta_product(s3, dated_features(spark, d), ["b04", "b08"], 2, fixture(spark, d, "era5_hourly"), cell, K.GAIN, K.OFFSET, K.DIRECTIONAL, tile="31PDR")[0]


@query(
    """+ e AS (SELECT MIN(acq_date) AS a, MAX(acq_date) AS b FROM s2_obs), k AS (SELECT DISTINCT CAST(date_trunc('month', x) AS DATE) + (CASE WHEN day(x)<=10 THEN 0 WHEN day(x)<=20 THEN 10 ELSE 20 END)::INT AS dekad FROM (SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS x FROM e))
SELECT '' AS geometry, strftime(dekad, '%Y-%m-%dT00:00:00Z') AS startTime, strftime(dekad + 1, '%Y-%m-%dT00:00:00Z') AS endTime, 'NDVI_' || strftime(dekad, '%Y%m%d') || '_31PDR.tif' AS filename, 'Normalized difference vegetation index' AS description FROM k""",
    "s2_obs",
)
def k7_ndvi_product(spark, d):
    """The manifest; k7_ndvi_cells has the cells."""
    return X.ndvi_product(fixture(spark, d, "s2_obs"), "31PDR")[1]


@query("+ " + MEDIANS.format(source="s2_obs") + filled_sql(["ndvi"]), "s2_obs")
def k7_ndvi_cells(spark, d):
    return rounded(X.ndvi_product(fixture(spark, d, "s2_obs"), "31PDR")[0])


@query()
def k8_correction_parameters(spark, d):
    m = fixture(spark, d, "matchup")
    return rounded(X.correction_parameters(m, m.columns, SEEDS))


@query(
    """+ b AS (SELECT acq_id, acq_id % 5 AS tile, acq_time, -15.0-0.01*MIN(row_lr) AS top, 25.0+0.01*(MAX(col_lr)+1) AS r, -15.0-0.01*(MAX(row_lr)+1) AS bottom, 25.0+0.01*MIN(col_lr) AS l FROM s3_obs GROUP BY 1, 2, 3),
s AS (SELECT event_type || '_' || event_id AS name, ts, event_id, 25.0+MOD(event_id,20)*0.02 AS x, -15.0-MOD(event_id,15)*0.02 AS y FROM events)
SELECT DISTINCT tile, name FROM b JOIN s ON ABS(epoch_us(acq_time)-epoch_us(ts)) <= 600000000 AND l <= x+0.005 AND r >= x-0.005 AND bottom <= y+0.005 AND top >= y-0.005 WHERE event_id % 3 <> 0 AND (name LIKE '%view%' OR name LIKE '%click%')""",
    "s3_obs",
)
def k9_find_simultaneous(spark, d):
    cells = fixture(spark, d, "s3_obs").select("acq_id", (F.col("acq_id") % 5).alias("tile"), F.col("acq_time").cast("timestamp_ntz").alias("acq_time"), F.col("row_lr").alias("row"), F.col("col_lr").alias("col"))
    bounds = X.acquisition_bounds(cells, G.Grid(25.0, 0.01, -15.0, -0.01, 10, 10), 4326, ["acq_id", "tile", "acq_time"])
    x, y = 25.0 + F.col("event_id") % 20 * 0.02, -15.0 - F.col("event_id") % 15 * 0.02
    found = table(spark, d, "events").select(F.concat_ws("_", "event_type", "event_id").alias("name"), F.col("ts").cast("timestamp_ntz").alias("time"), "event_id", (x - 0.005).alias("minx"), (x + 0.005).alias("maxx"), (y - 0.005).alias("miny"), (y + 0.005).alias("maxy"))
    return X.find_simultaneous(bounds, found, found.filter("event_id % 3 = 0"), ["view", "click"])


def above_mean(rows: pd.DataFrame, context: dict) -> pd.DataFrame:
    return pd.DataFrame({"px_id": rows["px_id"], "above": rows["lst"] - rows["lst"].mean() + context.get("offset", 0.0)})


@query(
    "SELECT row, col, COALESCE(arg_min(scl, acq_date) FILTER (scl <> 0), 0) AS scl FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY acq_date, row, col ORDER BY n DESC, scl) AS o FROM (SELECT acq_date, CAST(FLOOR((row_hr+0.5e0)*10/25) AS INT) AS row, CAST(FLOOR((col_hr+0.5e0)*10/25) AS INT) AS col, scl, COUNT(*) AS n FROM s2_obs GROUP BY ALL)) WHERE o = 1 GROUP BY 1, 2",
    "s2_obs",
)
def b9_regrid_mode(spark, d):
    """Classes of every date on cells of 25 m, overlaid in order of dates."""
    s2 = fixture(spark, d, "s2_obs").select("acq_date", F.col("row_hr").alias("row"), F.col("col_hr").alias("col"), "scl")
    coarse = G.regrid_mode(s2, "scl", G.Grid(0, 10.0, 0, -10.0, 20, 20), G.Grid(0, 25.0, 0, -25.0, 8, 8), ["acq_date"])
    return G.mosaic_first_nonzero(coarse, "scl", "acq_date")


@query("SELECT px_id, ROUND(lst - AVG(lst) OVER (PARTITION BY acq_id) + 1, 6) AS above FROM s3_obs", "s3_obs")
def l1_apply_over(spark, d):
    return rounded(X.apply_over(fixture(spark, d, "s3_obs").select("acq_id", "px_id", "lst"), ["acq_id"], above_mean, "px_id long, above double", {"offset": 1.0}))


@query("SELECT acq_date, row_hr, col_hr, ROUND((b08-b04)/NULLIF(b08+b04, 0), 6) AS ndvi FROM s2_obs", "s2_obs")
def l2_with_indices(spark, d):
    out = B.with_indices(fixture(spark, d, "s2_obs"), ["NDVI"], rename={"B08": "b08", "B04": "b04"})
    return out.select("acq_date", "row_hr", "col_hr", r6("NDVI").alias("ndvi"))



def sql_to_aeqd(source: str, lon: str, lat: str, lon0: float, lat0: float) -> str:
    for step in G.aeqd_steps(lon, lat, lon0, lat0):
        source = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM {source})"
    return source


def sql_from_aeqd(source: str, x: str, y: str, lon0: float, lat0: float) -> str:
    for step in G.from_aeqd_steps(x, y, lon0, lat0):
        source = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM {source})"
    return source


@query(f"SELECT px_id, ROUND(x, 3) AS x, ROUND(y, 3) AS y FROM {sql_to_aeqd('swath', 'lon', 'lat', 25.0175, -15.01)}", "swath")
def b3_to_aeqd(spark, d):
    """Pixels about a point of the swath; tests hold the projection against known arcs."""
    out = G.to_aeqd(fixture(spark, d, "swath"), "lon", "lat", 25.0175, -15.01)
    return out.select("px_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query("+ c AS (SELECT acq_date, row_hr AS row, col_hr AS col, AVG(b04) AS b04 FROM s2_obs GROUP BY 1, 2, 3), e AS (SELECT acq_date, MAX(row) AS mr, MAX(col) AS mc FROM c GROUP BY 1) SELECT e.acq_date, CAST(r.i AS INT) AS row, CAST(k.i AS INT) AS col, ROUND(b04, 6) AS b04 FROM e CROSS JOIN range(22) r(i) CROSS JOIN range(22) k(i) LEFT JOIN c ON c.acq_date = e.acq_date AND c.row = LEAST(r.i, mr) AND c.col = LEAST(k.i, mc)", "s2_obs")
def b21_pad_edges(spark, d):
    return rounded(G.pad_edges(dated_features(spark, d).select("acq_date", "row", "col", "b04"), "b04", 22, 22, ["acq_date"]))


@query("SELECT s3_time, s3_saa, validation_saa + CASE WHEN s3_time LIKE '%T213000' THEN -5 ELSE 4 END AS validation_saa, validation_vaa - CASE WHEN s3_time LIKE '%T213000' THEN 180 ELSE 0 END AS validation_vaa FROM matchup", "matchup")
def g2_align_azimuth(spark, d):
    """Evening pairs 175 degrees apart, morning pairs 4."""
    apart = F.when(F.col("s3_time").endswith("T213000"), 175).otherwise(4)
    m = fixture(spark, d, "matchup").withColumn("validation_saa", F.col("validation_saa") + apart)
    return M.align_azimuth(m, "s3_time").select("s3_time", "s3_saa", "validation_saa", "validation_vaa")


@query(DATED + ", m AS (SELECT acq_date, CAST(FLOOR(row/2) AS INT) AS row, CAST(FLOOR(col/2) AS INT) AS col, AVG(b04) AS b04, STDDEV_POP(b04) AS s04, AVG(b08) AS b08, STDDEV_POP(b08) AS s08 FROM fine GROUP BY 1, 2, 3), k AS (SELECT m.*, day, (s04/b04+s08/b08)/2 AS cv FROM m JOIN pairs USING (acq_date) JOIN low USING (day, row, col)) SELECT acq_date, day, row, col, ROUND(cv, 6) AS cv FROM k WHERE cv > 0 AND cv < (SELECT QUANTILE_CONT(cv, 0.8) FROM k WHERE cv > 0 AND cv < 1000)", "s2_obs s3_obs")
def i2_auto_cv_samples(spark, d):
    """Samples below the threshold that is found when none is given."""
    keys = ["acq_date", "day"]
    fine = dated_features(spark, d).join(scene_pairs(spark, d), "acq_date")
    out = I.training_samples(fine, paired_temperature(spark, d), ["b04", "b08"], 2, 0.0, keys)
    return rounded(out.select(*keys, "row", "col", "cv"))


@query()
def i6_i7_linear_correction(spark, d):
    """i6_i7_smoothed_correction with residuals of the temperatures themselves."""
    fine = dated_features(spark, d).select("acq_date", "row", "col", (280 + F.col("b04") * 40).alias("lst")).join(scene_pairs(spark, d), "acq_date")
    keys = ["acq_date", "day"]
    return rounded(I.correct_residuals(fine, paired_temperature(spark, d), 2, keys, 1)).select(*keys, "row", "col", "lst")


LINEAR = (("AVG(POWER(t,4))", "AVG(t)"), ("POWER(low.lst,4)-m", "low.lst-m"), ("POWER(COALESCE(r, near)+POWER(t,4),0.25)", "COALESCE(r, near)+t"))
ORACLES["i6_i7_linear_correction"] = ORACLES["i6_i7_smoothed_correction"]
for power, plain in LINEAR:
    ORACLES["i6_i7_linear_correction"] = ORACLES["i6_i7_linear_correction"].replace(power, plain)


# -- preprocessing as one call -----------------------------------------------------------


def preprocessed(spark, d, stage):
    """Acquisitions of 10 by 10 cells of 0.01 degree, coarse cells of 2.5 times, fine cells of half that size."""
    s3 = fixture(spark, d, "s3_obs").select("acq_id", "acq_time", F.col("row_lr").alias("row"), F.col("col_lr").alias("col"), "lst", "lst_uncertainty", "confidence_in", "vza")
    s2 = fixture(spark, d, "s2_obs").select("acq_date", F.col("row_hr").alias("row"), F.col("col_hr").alias("col"), "b04", "b08", "scl")
    dem = fixture(spark, d, "dem").select(F.col("row_hr").alias("row"), F.col("col_hr").alias("col"), "alt").filter("row < 20")
    area = lambda size, n: G.Grid(25.0, size, -15.0, -size, n, n)
    tile = PP.Tile((25.0, -15.1, 25.1, -15.0), area(0.01, 10), 4326, area(0.005, 20), area(0.025, 4), area(0.005, 20), 4326)
    root = f"{shared_dir(spark)}/thermal/preprocess-{uuid.uuid4().hex}"
    # written, or every commit would derive the acquisitions anew
    PP.preprocess(root, staged(s3, "acquisitions"), s2, dem, tile)
    return PP.read(spark, root, stage, decoded=False)


@query("SELECT acq_id, acq_time, CAST(r AS INT) AS row, CAST(c AS INT) AS col, CAST(TRUNC(lst/0.01e0) AS INT) AS lst, CASE WHEN (confidence_in >> 14) & 1 = 0 AND lst_uncertainty <= 1 THEN 1 ELSE 0 END AS quality_flag FROM s3_obs, range(4) a(r), range(4) b(c) WHERE row_lr = FLOOR((r+0.5)*2.5) AND col_lr = FLOOR((c+0.5)*2.5)", "s3_obs")
def k4_thermal(spark, d):
    """Stored temperatures and flags of the source cells at the centres of coarse cells."""
    return preprocessed(spark, d, "thermal").select("acq_id", "acq_time", "row", "col", F.col("lst").cast("int").alias("lst"), F.col("quality_flag").cast("int").alias("quality_flag"))


@query(
    """+ h AS (SELECT row_hr AS row, col_hr AS col, TRUNC(alt) AS alt FROM dem WHERE row_hr < 20),
s AS (SELECT h.row, h.col, COUNT(*) AS n, SUM(dc*(2-ABS(dr))*x.alt)/(8*0.005) AS gx, SUM(dr*(2-ABS(dc))*x.alt)/(8*0.005) AS gy FROM h, range(-1, 2) p(dr), range(-1, 2) q(dc), h x WHERE x.row=h.row+dr AND x.col=h.col+dc GROUP BY 1, 2),
g AS (SELECT row, col, CASE WHEN n=9 THEN ATAN(SQRT(gx*gx+gy*gy)) ELSE 0 END AS slo, CASE WHEN n=9 AND (gx<>0 OR gy<>0) THEN CASE WHEN ATAN2(-gx,gy)<0 THEN ATAN2(-gx,gy)+2*PI() ELSE ATAN2(-gx,gy) END ELSE 0 END AS asp, -15.0-0.005*(row+0.5) AS lat, 25.0+0.005*(col+0.5) AS lon, (row+0.5)/2-0.5 AS fr, (col+0.5)/2-0.5 AS fc FROM s),
w AS (SELECT g.*, CAST(FLOOR(fr)+i AS INT) AS sr, CAST(FLOOR(fc)+j AS INT) AS sc, {wr} AS wr, {wc} AS wc FROM g, range(-1, 3) x(i), range(-1, 3) y(j)),
v AS (SELECT acq_id, acq_time, row, col, lat, lon, slo, asp, SUM(wr*wc*vza)/SUM(wr*wc) AS vza FROM w JOIN s3_obs ON row_lr=sr AND col_lr=sc WHERE wr*wc > 0 GROUP BY ALL),
t AS (SELECT *, dayofyear(acq_time) AS doy, hour(acq_time)+minute(acq_time)/60.0 AS ft FROM v), d AS (SELECT *, RADIANS(23.45)*SIN(2*PI()*doy/365-1.39) AS dec FROM t),
o AS (SELECT *, RADIANS((12-(ft-(-(0.258*COS(dec)-7.416*SIN(dec)-3.648*COS(2*dec)-9.228*SIN(2*dec))/60.0+(0-lon)/15.0)))*15) AS w FROM d)
SELECT acq_id, acq_time, row, col, ROUND(CAST(CAST(SIN(dec)*SIN(RADIANS(lat))*COS(slo)+SIN(dec)*COS(RADIANS(lat))*SIN(slo)*COS(asp)+COS(dec)*COS(RADIANS(lat))*COS(slo)*COS(w)-COS(dec)*SIN(RADIANS(lat))*SIN(slo)*COS(asp)*COS(w)-COS(dec)*SIN(slo)*SIN(asp)*SIN(w) AS FLOAT) AS DOUBLE), 3)+0.0e0 AS inc, ROUND(CAST(CAST(vza AS FLOAT) AS DOUBLE), 2) AS vza FROM o""".replace("{wr}", spline_sql("ABS(fr-FLOOR(fr)-i)")).replace("{wc}", spline_sql("ABS(fc-FLOOR(fc)-j)")),
    "s3_obs dem",
)
def k4_angles(spark, d):
    """Incidence on the fine grid's slopes and resampled view angles, stored in single precision."""
    out = preprocessed(spark, d, "angles")
    return out.select("acq_id", "acq_time", "row", "col", *((F.round(F.col(c).cast("double"), n) + 0.0).alias(c) for c, n in (("inc", 3), ("vza", 2))))


# -- grids, windows, files ---------------------------------------------------------------


@query(f"+ q AS (SELECT px_id, CAST(MOD(px_id, 41)-20 AS DOUBLE)*500 AS px, CAST(MOD(px_id, 37)-18 AS DOUBLE)*500 AS py FROM swath) SELECT px_id, ROUND(lon, 7) AS lon, ROUND(lat, 7) AS lat FROM {sql_from_aeqd('q', 'px', 'py', 25.0175, -15.01)}", "swath")
def b3_from_aeqd(spark, d):
    """Points up to 10 km around a point; tests hold the way there and back below a millimetre."""
    at = fixture(spark, d, "swath").select("px_id", ((F.col("px_id") % 41 - 20) * 500.0).alias("px"), ((F.col("px_id") % 37 - 18) * 500.0).alias("py"))
    out = G.from_aeqd(at, "px", "py", 25.0175, -15.01)
    return out.select("px_id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query(
    """+ hr AS (SELECT row_hr AS row, col_hr AS col, 280+alt/20 AS t FROM dem),
m AS (SELECT CAST(FLOOR(row/2) AS INT) AS row, CAST(FLOOR(col/2) AS INT) AS col, AVG(POWER(t,4)) AS m FROM hr GROUP BY 1, 2),
r AS (SELECT row, col, CASE WHEN (row+col) % 4 <> 0 THEN POWER(281.0+((row*7+col*3) % 5),4)-m END AS r FROM m),
e AS (SELECT MIN(row) AS r0, MAX(row) AS r1, MIN(col) AS c0, MAX(col) AS c1 FROM r),
x AS (SELECT r.*, (2-ABS(dr))*(2-ABS(dc)) AS w, LEAST(r1, GREATEST(r0, row+dr)) AS sr, LEAST(c1, GREATEST(c0, col+dc)) AS sc FROM r, e, (VALUES (-1),(0),(1)) a(dr), (VALUES (-1),(0),(1)) b(dc)),
s AS (SELECT x.row, x.col, CASE WHEN MAX(x.r) IS NOT NULL THEN SUM(w*y.r)/SUM(CASE WHEN y.r IS NOT NULL THEN w END) END AS r FROM x JOIN r y ON y.row=sr AND y.col=sc GROUP BY 1, 2),
q AS (SELECT *, (row+0.5)/2-0.5 AS fr, (col+0.5)/2-0.5 AS fc FROM hr),
n AS (SELECT q.*, FLOOR(fr)+i AS sr, FLOOR(fc)+j AS sc, (1-ABS(fr-FLOOR(fr)-i))*(1-ABS(fc-FLOOR(fc)-j)) AS w FROM q, range(2) a(i), range(2) b(j)),
f AS (SELECT n.row, n.col, n.t, SUM(w*s.r)/SUM(CASE WHEN s.r IS NOT NULL THEN w END) AS r FROM n LEFT JOIN s ON s.row=sr AND s.col=sc GROUP BY 1, 2, 3),
z AS (SELECT f.row, f.col, CASE WHEN COUNT(*)=4 THEN AVG(g.r) END AS near FROM f JOIN f g ON (f.row=g.row AND ABS(f.col-g.col)=1) OR (f.col=g.col AND ABS(f.row-g.row)=1) GROUP BY 1, 2)
SELECT 0 AS scene, row, col, ROUND(POWER(COALESCE(r, near)+POWER(t,4),0.25),6) AS lst FROM f LEFT JOIN z USING (row, col)""",
    "dem",
)
def b16_windows_correction(spark, d):
    """Residuals of coarse cells, a quarter of them bad, in windows of 7 by 5 that bring their border along."""
    fine = fixture(spark, d, "dem").select(F.lit(0).alias("scene"), F.col("row_hr").alias("row"), F.col("col_hr").alias("col"), (280 + F.col("alt") / 20).alias("lst"))
    rows, cols = fine.agg(*(F.coalesce(F.max(c) + 1, F.lit(0)) for c in ("row", "col"))).first()
    low = fine.select("scene", F.floor(F.col("row") / 2).cast("int").alias("row"), F.floor(F.col("col") / 2).cast("int").alias("col")).distinct()
    low = low.select("*", (281.0 + (F.col("row") * 7 + F.col("col") * 3) % 5).alias("lst"), F.when((F.col("row") + F.col("col")) % 4 != 0, 1).otherwise(0).alias("quality"))
    w = W.Windows(G.Grid(0, 2, 0, 2, -(-cols // 2), -(-rows // 2)), G.Grid(0, 1, 0, 1, cols, rows), 2, 7, 5)
    return rounded(W.correct_residuals(fine, low, ["scene"], w))


@query("SELECT lst_s3hr, s3_vza, s3_vaa, s3_sza, s3_saa, validation_lst, validation_vza, validation_vaa, validation_sza, validation_saa, land_cover, s3_time, validation_cloudmask FROM matchup", "matchup")
def a8_read_matchups(spark, d):
    """Match-ups written as CSV and read back, mornings from files with the older names."""
    m, root = fixture(spark, d, "matchup"), f"{shared_dir(spark)}/thermal/csv-{uuid.uuid4().hex}"
    early = F.col("s3_time").endswith("T093000")
    m.filter(~early).write.option("header", "true").csv(f"{root}/now")
    m.filter(early).withColumnsRenamed({new: old for old, new in A.LEGACY.items()}).write.option("header", "true").csv(f"{root}/then")
    return A.read_matchups(spark, [f"{root}/now"], [f"{root}/then"]).drop("src_file")


@query("SELECT acq_id, CAST(row_lr AS INT) AS row, CAST(col_lr AS INT) AS col, ROUND(lst, 6) AS value, ROUND(25.0e0+(col_lr+0.5e0)*0.01e0, 6) AS x, ROUND(-15.0e0-(row_lr+0.5e0)*0.01e0, 6) AS y FROM s3_obs", "s3_obs")
def a18_cube_to_cells(spark, d):
    """Acquisitions as nested arrays, a row of cells each, and back."""
    lines = fixture(spark, d, "s3_obs").groupBy("acq_id", "row_lr").agg(F.sort_array(F.collect_list(F.struct("col_lr", "lst"))).alias("line"))
    cube = lines.groupBy("acq_id").agg(F.sort_array(F.collect_list(F.struct("row_lr", F.transform("line", lambda x: x["lst"]).alias("v")))).alias("rows"))
    cells = A.cube_to_cells(cube.select(F.col("acq_id").alias("acq_time"), F.transform("rows", lambda x: x["v"]).alias("values")), 25.0, 0.01, -15.0, -0.01)
    return rounded(cells.select(F.col("acq_time").alias("acq_id"), "row", "col", "value", "x", "y"))


@query("+ l AS (SELECT DISTINCT CAST(MOD(px_id,4) AS INT) AS cell_id, acq_time, CAST(CAST(acq_time + INTERVAL 2 HOUR AS DATE) AS TIMESTAMP) - INTERVAL 2 HOUR AS s FROM s3_obs), " + OBS.lstrip().removeprefix("+ ") + " SELECT f.cell_id, f.acq_time, ROUND(x.t2m*frac+y.t2m*(1-frac),6) AS t2m, ROUND(COALESCE((SELECT SUM(sp) FROM era5_hourly e WHERE e.cell_id=f.cell_id AND valid_time>l.s AND valid_time<=l.s+INTERVAL 24 HOUR),0)/86400,6) AS sp FROM f JOIN l ON l.cell_id=f.cell_id AND l.acq_time=f.acq_time JOIN era5_hourly x ON x.cell_id=f.cell_id AND x.valid_time=b JOIN era5_hourly y ON y.cell_id=f.cell_id AND y.valid_time=a", "s3_obs era5_hourly")
def k5_daily_flux(spark, d):
    """Temperatures in time with the mean flux of the local day."""
    return rounded(K.era5_at(observations(spark, d), fixture(spark, d, "era5_hourly"), radiation="sp", time_zone=2.0).select("cell_id", "acq_time", "t2m", "sp"))


SWATH_E = "+ e AS (SELECT MIN(lon) AS x0, MAX(lat) AS y0, CAST(FLOOR((MAX(lon)-MIN(lon))/0.0007+1e-6) AS BIGINT)+1 AS nc, CAST(FLOOR((MAX(lat)-MIN(lat))/0.0007+1e-6) AS BIGINT)+1 AS nr FROM swath)"


def swath_grid(spark, d):
    found = fixture(spark, d, "swath")
    x0, x1, y0, y1 = found.agg(*(F.coalesce(f(c), F.lit(0.0)) for c, f in (("lon", F.min), ("lon", F.max), ("lat", F.max), ("lat", F.min)))).first()
    return found, G.Grid(x0, 0.0007, y0, -0.0007, int((x1 - x0) / 0.0007 + 1e-6) + 1, int((y0 - y1) / 0.0007 + 1e-6) + 1)


@query()
def b18_swath_plane(spark, d):
    """Nearest pixels in the azimuthal plane about the grid's middle; tests hold it against brute force."""
    found, g = swath_grid(spark, d)
    return rounded(S.grid_swath_plane(found, g, ["lst"]))


def swath_inputs(spark, d):
    """Three granules of the swath on as many days, and scenes half a cell fine whose temperatures are 1.1 times the granule's less 30, in the plane of the same grid."""
    found, g = swath_grid(spark, d)
    day = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n")
    time = F.timestamp_add("DAY", F.col("n"), F.lit("2024-03-01 09:30:00").cast("timestamp_ntz"))
    angle = lambda k, m: ((F.col("px_id") * k + F.col("n")) % m).cast("double")
    at = found.select("*", day).select(F.lit("31PDR").alias("tile"), F.concat(F.lit("g"), "n").alias("granule"), time.alias("time"), "n", "px_id", "lon", "lat", "lst")
    seen = {"vza": angle(7, 25), "vaa": angle(11, 360)}
    granules = at.withColumns(seen | {"sza": F.lit(30.0), "saa": F.lit(120.0), "cloudmask": F.when(F.col("px_id") % 17 == 0, 1).otherwise(0), "land_fraction": F.lit(1.0)})
    # the granules' pixels lie at the same places, so that a day differs in angles alone
    nearest = S.grid_swath_plane(found.withColumn("pixel", F.col("px_id")), g, ["pixel", "lst"]).withColumnRenamed("pixel", "px_id")
    on_grid = nearest.select("row", "col", "px_id", "lst", day).withColumns(seen)
    half = F.explode(F.sequence(F.lit(0), F.lit(1)))
    fine = on_grid.withColumn("i", half).withColumn("j", half)
    scenes = fine.select(F.lit("31PDR").alias("tile"), F.concat(F.lit("s"), "n").alias("scene"), F.timestamp_add("DAY", F.col("n"), F.lit("2024-03-01 09:34:00").cast("timestamp_ntz")).alias("time"), (2 * F.col("row") + F.col("i")).alias("row"), (2 * F.col("col") + F.col("j")).alias("col"), (1.1 * F.col("lst") - 30).alias("lst"), (F.col("vza") + 3).alias("vza"), ((F.col("vaa") + 90) % 360).alias("vaa"), F.lit(30.0).alias("sza"), F.lit(120.0).alias("saa"))
    cover = on_grid.select("row", "col", (10 * (1 + (F.col("row") + F.col("col")) % 9)).alias("land_cover")).distinct()
    return granules.drop("n"), scenes, cover, g


@query()
def k8_parameters_from_swath(spark, d):
    """From swaths to parameters in one call."""
    granules, scenes, cover, g = swath_inputs(spark, d)
    return rounded(X.parameters_from_swath(granules, scenes, cover, g, 2))


@query()
def a13_write_params(spark, d):
    """A sample's parameters written, a line each, and read back."""
    at = f"{shared_dir(spark)}/thermal/params-{uuid.uuid4().hex}"
    m = fixture(spark, d, "matchup").withColumn("sample_id", F.floor(F.col("land_cover") / 30).cast("int"))
    found = H.estimate_parameters(m)
    X.write_params(found, at)
    return rounded(spark.read.schema(found.schema).json(at))


ORACLES["a13_write_params"] = ORACLES["h21_estimate_parameters"]
