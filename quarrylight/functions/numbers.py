"""Numbers, dates, geometry and cost: Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    a, b = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(a), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(b), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def in_polygon(lat: Column, lon: Column, vertices: Sequence[tuple[float, float]], eps: float = 1e-9) -> Column:
    """Whether a point is inside a polygon of (lat, lon) vertices or on its edge, by ray casting."""
    crossings, on_edge = F.lit(0), F.lit(False)
    for (y1, x1), (y2, x2) in zip(vertices, [*vertices[1:], vertices[0]], strict=True):
        side = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
        on_edge = on_edge | ((F.abs(side) <= eps) & lat.between(min(y1, y2) - eps, max(y1, y2) + eps) & lon.between(min(x1, x2) - eps, max(x1, x2) + eps))
        if y1 != y2:
            at = (lat - y1) * ((x2 - x1) / (y2 - y1)) + x1
            crossings = crossings + F.when(((lat < y1) != (lat < y2)) & (lon < at), 1).otherwise(0)
    return on_edge | (crossings % 2 == 1)


def zone(lat: Column, lon: Column, outer: Sequence[tuple[float, float]], inner: Sequence[tuple[float, float]]) -> Column:
    """core (weight 5) inside the inner polygon, outer_band (1) between the two, outside (0)."""
    return F.when(in_polygon(lat, lon, inner), "core").when(in_polygon(lat, lon, outer), "outer_band").otherwise("outside")


def zone_weight(name: Column) -> Column:
    return F.when(name == "core", 5).when(name == "outer_band", 1).otherwise(0)


def refresh_due(checked: Column, site_class: Column, worth: Column) -> Column:
    """When a site is due again: classes A to C that are worth it daily, D and E or limited weekly, the rest monthly."""
    daily, weekly = site_class.isin("A", "B", "C") & (worth == "true"), site_class.isin("D", "E") | (worth == "limited")
    return checked + F.make_interval(days=F.when(daily, 1).when(weekly, 7).otherwise(30))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, never negative; null if either is missing."""
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0.0), end.cast("double") - start.cast("double")))


def usage_cost(inputs: Column, cached: Column, outputs: Column, prices: tuple[str, str, str]) -> Column:
    """Cost in USD at prices per million (input, cached, output), decimal, half up to 8 places; null tokens give null."""
    p_in, p_cached, p_out = (F.lit(p).cast("decimal(10,4)") for p in prices)
    hit = F.least(F.greatest(F.coalesce(cached, F.lit(0)), F.lit(0)), inputs)
    total = (inputs - hit).cast("decimal(18,0)") * p_in + hit.cast("decimal(18,0)") * p_cached + outputs.cast("decimal(18,0)") * p_out
    return F.round((total / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(38,18)"), 8)


def wall_seconds(name: str) -> Column:
    """Seconds since 1970 of a timestamp column's wall time, whatever the session's zone."""
    c = F.col(name)
    return F.unix_date(c.cast("date")) * 86400.0 + F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c).cast("double")
