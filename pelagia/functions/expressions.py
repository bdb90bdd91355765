"""Column expressions; everything here stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088

NOISE = -1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""
    la1, la2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = (la2 - la1) / 2
    half_lon = (F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2
    h = F.sin(half_lat) * F.sin(half_lat) + F.cos(la1) * F.cos(la2) * F.sin(half_lon) * F.sin(half_lon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def to_double(c) -> Column:
    """Text to double; anything unreadable, and NaN, becomes null."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def concat_key(cols: list[str], sep: str = "_") -> Column:
    """Join columns with ``sep``; null as soon as one of them is null."""
    parts = [F.col(cols[0])]
    for c in cols[1:]:
        parts += [F.lit(sep), F.col(c)]
    return F.concat(*parts)


def is_noise(cluster="cluster") -> Column:
    return _col(cluster) == NOISE


def cluster_name(cluster="cluster") -> Column:
    return F.when(is_noise(cluster), F.lit("Noise")).otherwise(
        F.concat(F.lit("Cluster "), _col(cluster).cast("string")))


def group_label(group, count) -> Column:
    """First 25 characters of the group and its number of observations."""
    return F.concat(F.substring(_col(group), 1, 25), F.lit(" ("), _col(count).cast("string"), F.lit(" obs)"))


def count_label(name, count) -> Column:
    return F.concat(_col(name), F.lit(" (n="), _col(count).cast("string"), F.lit(")"))


def percent_text(part, whole) -> Column:
    """Share as text with two decimals, ``12.34%``; null when the whole is zero."""
    return F.format_string("%.2f%%", F.try_divide(_col(part) * 100.0, _col(whole)))


def stable_order(row_id, seed: int = 0) -> Column:
    """Pseudo-random sort key that depends only on the row id and the seed."""
    return F.md5(F.concat_ws(":", _col(row_id).cast("string"), F.lit(str(seed))))
