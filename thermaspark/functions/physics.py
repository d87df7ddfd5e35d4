"""Scalar physics and angle functions as column expressions. Angles in degrees unless a name says otherwise; temperatures in kelvin."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGMA = 5.670374e-8
#: Heat capacities of dry air and water vapour at constant pressure.
CP_DRY, CP_VAPOUR = 1003.5, 1865.0
#: Meteorological constants: ratio of molecular weights, specific gas constant of dry air, gravity (moist lapse rate, geopotential).
EPSILON, R_DRY, GRAVITY_LAPSE, GRAVITY = 0.622, 287.04, 9.8, 9.80665


def declination(doy: Column) -> Column:
    """Solar declination in radians."""
    return F.radians(F.lit(23.45)) * F.sin(F.lit(2 * math.pi) * doy / 365 - 1.39)


def hour_angle(ftime: Column, decl: Column, lon: Column, stdlon: float = 0.0) -> Column:
    """Radians; positive in the morning. ftime: decimal hours of the zone around stdlon."""
    minutes = 0.258 * F.cos(decl) - 7.416 * F.sin(decl) - 3.648 * F.cos(2 * decl) - 9.228 * F.sin(2 * decl)
    solar = ftime + minutes / 60 + (lon - stdlon) / 15
    return F.radians((12 - solar) * 15)


def decimal_hour(t: Column) -> Column:
    """Hours and minutes; seconds are dropped."""
    return F.hour(t) + F.minute(t) / 60


def cos_incidence(lat: Column, lon: Column, doy: Column, ftime: Column, aspect: Column, slope: Column, stdlon: float = 0.0) -> Column:
    """Cosine between the sun and the normal of a slope; aspect and slope in radians."""
    decl, phi = declination(doy), F.radians(lat)
    omega = hour_angle(ftime, decl, lon, stdlon)
    level, tilt = F.cos(slope), F.sin(slope)
    fixed = F.sin(decl) * (F.sin(phi) * level + F.cos(phi) * tilt * F.cos(aspect))
    moving = F.cos(phi) * level * F.cos(omega) - F.sin(phi) * tilt * F.cos(aspect) * F.cos(omega) - tilt * F.sin(aspect) * F.sin(omega)
    return fixed + F.cos(decl) * moving


def slope_angle(rise_over_run: Column, compat: bool = False) -> Column:
    """Radians. compat: the rise over run read as degrees, as an earlier processor does."""
    return F.radians(rise_over_run) if compat else F.atan(rise_over_run)


def heat_capacity(p: Column, ea: Column) -> Column:
    """Of moist air, J kg-1 K-1."""
    q = EPSILON * ea / (p + (EPSILON - 1) * ea)
    return (1 - q) * CP_DRY + q * CP_VAPOUR


def latent_heat(t: Column) -> Column:
    return 1e6 * (2.501 - 2.361e-3 * (t - 273.15))


def mixing_ratio(ea: Column, p: Column) -> Column:
    return EPSILON * ea / (p - ea)


def lapse_rate_moist(t: Column, ea: Column, p: Column) -> Column:
    """K m-1."""
    r, cp, lv = mixing_ratio(ea, p), heat_capacity(p, ea), latent_heat(t)
    return GRAVITY_LAPSE * (R_DRY * t * t + lv * r * t) / (cp * R_DRY * t * t + lv * lv * r * EPSILON)


def temp_at_height(t: Column, ea: Column, p: Column, z: Column, z_ta: float | Column = 2.0) -> Column:
    return t - lapse_rate_moist(t, ea, p) * (z - z_ta)


def vapour_pressure(d2m: Column) -> Column:
    """Tetens on the dew point, hPa."""
    c = d2m - 273.15
    return 6.1078 * F.exp(17.27 * c / (c + 237.3))


def air_pressure(sp: Column) -> Column:
    """Pa to hPa."""
    return sp / 100


def datum_temperature(t2m: Column, d2m: Column, sp: Column, z: Column) -> Column:
    """Air temperature taken down to sea level; z is a geopotential."""
    return temp_at_height(t2m, vapour_pressure(d2m), air_pressure(sp), F.lit(0.0), z / GRAVITY + 2)


def air_temperature(t_datum: Column, ea: Column, p: Column, elevation: Column) -> Column:
    """At 100 m above the ground."""
    return temp_at_height(t_datum, ea, p, elevation + 100, 0.0)


def lst_minus_ta(lst: Column, ta: Column) -> Column:
    return lst - ta


def sun_sensor_angle(vza1: Column, vza2: Column, vaa1: Column, vaa2: Column) -> Column:
    """Between two directions, degrees."""
    a, b = F.radians(vza1), F.radians(vza2)
    cos = F.cos(a) * F.cos(b) + F.sin(a) * F.sin(b) * F.cos(F.radians(vaa1 - vaa2))
    return F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos))))


def zenith_difference(vza1: Column, vza2: Column, valid: Column) -> Column:
    return F.when(valid, vza1 - vza2)


def normalize_angle(a: Column) -> Column:
    """Into [0, 360)."""
    return F.pmod(a, F.lit(360.0))


def radiance(t: Column) -> Column:
    return SIGMA * F.pow(t, 4)


def brightness(l: Column) -> Column:  # noqa: E741
    return F.pow(l / SIGMA, 0.25)


def kernel_vinnikov(vza: Column) -> Column:
    return 1 - F.cos(F.radians(vza))


def kernel_lsf(vza: Column) -> Column:
    """Directional emissivity kernel with four terms."""
    c = F.cos(F.radians(vza))
    return (1 + 2 * c) / (math.sqrt(0.96) + 1.92 * c) - 0.25 * c / (1 + 2 * c) + 0.15 * (1 - F.exp(-0.75 / c)) - 1.0304


def model_vinnikov(amplitude: Column, vza_s3: Column, vza_val: Column) -> Column:
    return amplitude * (F.cos(F.radians(vza_val)) - F.cos(F.radians(vza_s3)))


def model_lsf(amplitude: Column, vza_s3: Column, vza_val: Column) -> Column:
    return amplitude * (kernel_lsf(vza_s3) - kernel_lsf(vza_val))


def hotspot_distance(sza: Column, saa: Column, vza: Column, vaa: Column) -> Column:
    s, v = F.tan(F.radians(sza)), F.tan(F.radians(vza))
    return F.sqrt(F.greatest(F.lit(0.0), s * s + v * v - 2 * s * v * F.cos(F.radians(vaa - saa))))


def kernel_hotspot(k: Column, sza: Column, saa: Column, vza: Column, vaa: Column) -> Column:
    return hotspot_at(k, hotspot_distance(sza, saa, vza, vaa), F.tan(F.radians(sza)))


def hotspot_at(k: Column, distance: Column, sun: Column) -> Column:
    """The kernel from what doesn't depend on k: the distance and the tangent of the sun's zenith angle."""
    nadir = F.exp(-k * sun)
    return (F.exp(-k * distance) - nadir) / F.nullif(1 - nadir, F.lit(0.0))


def model_vinnikov_rl(a: Column, b: Column, k: Column, s3: tuple[Column, ...], val: tuple[Column, ...]) -> Column:
    """s3 and val: (vza, vaa, sza, saa) of both sensors."""
    rl = [kernel_hotspot(k, sza, saa, vza, vaa) for vza, vaa, sza, saa in (s3, val)]
    return a * (F.cos(F.radians(val[0])) - F.cos(F.radians(s3[0]))) + b * (rl[0] - rl[1])


def cross_calibrate(lst: Column, gain: Column | float, offset: Column | float) -> Column:
    return F.when(lst != 0, (lst - offset) / gain).otherwise(lst)


def correct_direction(lst: Column, vza: Column, amplitude: Column | float, kernel=kernel_vinnikov) -> Column:
    return F.when(lst != 0, lst - amplitude * kernel(vza)).otherwise(lst)


def correct_lst(lst: Column, vza: Column, gain: float | None, offset: float | None, amplitude: float | None) -> Column:
    """Cross-calibration if gain and offset are given, then the directional correction if its parameter is."""
    out = cross_calibrate(lst, gain, offset) if gain is not None and offset is not None else lst
    return correct_direction(out, vza, amplitude) if amplitude is not None else out


def sample_weight(n: Column, full: int = 10_000) -> Column:
    return F.when(n <= full, F.lit(1.0 / full)).otherwise((1 + F.log10(n / full)) / n)


def seasonal_weight(day: Column, reference: Column) -> Column:
    phase = F.pmod(F.datediff(day, reference), F.lit(180))
    return 0.5 - 0.5 * F.cos(F.lit(2 * math.pi) * phase / 180)
