"""Band registry: scale, storage type and nodata value by band name; decoding and encoding; derived indices."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """value = stored * scale + offset; nodata is a stored value."""

    scale: float | None = None
    dtype: str | None = None
    nodata: float | None = 0
    offset: float = 0.0


#: Spark has no unsigned types: the smallest signed type that holds them.
TYPES = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "int16": "smallint", "float32": "float"}
LIMITS = {"uint8": (0, 255), "uint16": (0, 65535), "uint32": (0, 4294967295), "int16": (-32768, 32767)}

# Stored units per physical unit, storage type, nodata.
FIXED = {
    "S2-refl": (10000, "uint16", 0),
    "S2-leafrefl": (10000, "uint16", 0),
    "S2-fapar_8": (100, "uint8", 0),
    "S2-lai": (10, "uint8", 0),
    "S2-fcover": (100, "uint8", 0),
    "S2-ccc": (100, "uint32", 0),
    "S2-cwc": (1000, "uint16", 0),
    "S2-fgreenveg": (100, "uint8", 0),
    "veg_height": (10, "uint16", 65535),
    "veg_struct": (100, "uint8", 255),
    "igbp_classification": (None, "uint8", 255),
    "roughness_length": (10000, "uint32", 4294967295),
    "zero_plane_displacement": (100, "uint16", 65535),
    "DEM-alt-20m": (None, "int16", 11000),
    "DEM-slo-20m": (None, "float32", -9999),
    "DEM-asp-20m": (None, "uint8", 255),
    "S3-LST": (100, "uint16", 0),
    "S3-LSTHR": (100, "uint16", 0),
    "S3-LSTHR-nocor": (None, "float32", None),
    "S3-geo": (None, "float32", -9999),
    "S3-mask": (None, "uint8", 255),
    "S3-CV": (None, "float32", -9999),
    "METEO-air_pressure": (100, "uint16", 65535),
    "METEO-air_temperature": (100, "uint16", 0),
    "METEO-average_daily_solar_irradiance": (10, "uint16", 65535),
    "METEO-clear_sky_solar_radiation": (10, "uint16", 65535),
    "METEO-t2m": (100, "uint16", 0),
    "METEO-vapour_pressure": (100, "uint16", 65535),
    "METEO-wind_speed": (1000, "uint16", 65535),
    "lst-ta": (100, "int16", -999),
    "et": (100, "uint16", 65535),
}
GROUPS = {
    "S2-refl": ("B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B11", "B12"),
    "S3-geo": ("S3-lat", "S3-lon", "S3-latHR", "S3-lonHR", "S3-vza", "S3-sza", "S3-vzaHR", "S3-szaHR", "S3-inc"),
}
#: Physical units per stored unit.
REGISTRY = {name: Band(1.0 / s if s else None, t, n) for name, (s, t, n) in FIXED.items()}


def band(name: str) -> Band:
    """By name, else by group; unknown names are stored as they are with nodata 0."""
    group = next((g for g, names in GROUPS.items() if name in names), name)
    return REGISTRY.get(group, Band())


def decoded(stored: Column, b: Band) -> Column:
    """Physical values; nodata is tested before scaling and becomes null, as NaN does."""
    value = stored.cast("double") * (b.scale or 1.0) + b.offset
    gone = F.isnan(stored.cast("double")) if b.nodata is None else (stored == b.nodata) | F.isnan(stored.cast("double"))
    return F.when(~gone, value)


def encoded(value: Column, b: Band) -> Column:
    """Stored values, truncated toward zero; missing and out of range become nodata."""
    raw = (value - b.offset) / (b.scale or 1.0)
    if b.dtype in LIMITS:
        low, high = LIMITS[b.dtype]
        whole = F.when(raw >= 0, F.floor(raw)).otherwise(F.ceil(raw))
        raw = F.when((whole >= low) & (whole <= high), whole)
    return F.coalesce(raw, F.lit(b.nodata)).cast(TYPES.get(b.dtype, "double"))


def decode(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """columns: column name to band name."""
    return df.withColumns({c: decoded(F.col(c), band(b)) for c, b in columns.items()})


def encode(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: encoded(F.col(c), band(b)) for c, b in columns.items()})


#: Derived indices: name to (bands, native resolution in metres, expression).
INDICES: dict[str, tuple[tuple[str, ...], int, Callable[..., Column]]] = {
    "NDVI": (("B08", "B04"), 10, lambda nir, red: (nir - red) / F.nullif(nir + red, F.lit(0.0))),
}


def with_indices(df: DataFrame, names: Iterable[str], more: dict | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Adds indices by name; `more` overrides or adds entries, `rename` maps band names to columns."""
    table = INDICES | (more or {})
    unknown = [n for n in names if n not in table]
    if unknown:
        raise ValueError(f"unknown index {unknown}")
    col = lambda b: F.col((rename or {}).get(b, b))
    return df.withColumns({n: table[n][2](*map(col, table[n][0])) for n in names})
