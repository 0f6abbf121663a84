"""Numbers: scores, coordinates, codes, boxes and digests."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def whole(c: Column) -> Column:
    """The integer of a text, else null."""
    return c.try_cast("int")


def real(c: Column) -> Column:
    return c.try_cast("double")


def unit(c: Column) -> Column:
    """A confidence, from 0 to 1; 0 where there is none."""
    x = real(c.cast("string"))
    return F.when(x.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def place_confidence(base: Column, relation: Column, active: Column, located: Column, length: Column, candidates: Column) -> Column:
    """How sure a mention's place is: its own confidence, time, activity, coordinates and length for it, rival places against it."""
    time = F.when(relation == "in_validity", 0.12).when(relation.isin("before_validity", "after_validity"), -0.25).otherwise(0.0)
    bonus = F.when(active, 0.04).otherwise(0.0) + F.when(located, 0.04).otherwise(0.0)
    longer = F.least(F.lit(0.10), F.greatest(F.lit(0), length - 2) * 0.012)
    rivals = F.least(F.lit(0.20), F.log10(F.greatest(candidates, F.lit(1)).cast("double")) * 0.05)
    return F.greatest(F.lit(0.05), F.least(F.lit(0.99), base + time + bonus + longer - rivals))


def admin_level(code: Column) -> Column:
    """sido, sigungu, eupmyeondong or ri, by the zeros that end a ten-digit code."""
    return F.when(~code.rlike("^[0-9]{10}$") | code.isNull(), "unknown").when(code.rlike("0{8}$"), "sido").when(code.rlike("0{5}$"), "sigungu").when(code.rlike("00$"), "eupmyeondong").otherwise("ri")


def admin_code(c: Column) -> Column:
    """Two or five digits padded to ten; other codes as they are."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(t.rlike("^([0-9]{2}|[0-9]{5})$"), F.rpad(t, 10, "0")).otherwise(t)


#: GRS80 and the unified Korean grid.
AXIS, FLAT, SCALE, EAST0, NORTH0, LAT0, LON0 = 6378137.0, 1 / 298.257222101, 0.9996, 1e6, 2e6, 38.0, 127.5


def wgs84(x: Column, y: Column) -> Column:
    """Struct of lat and lon of unified-grid coordinates, by the inverse transverse Mercator series; degrees pass through; null where either is missing."""
    e = 2 * FLAT - FLAT**2
    second = e / (1 - e)
    arc = (1 - e / 4 - 3 * e**2 / 64 - 5 * e**3 / 256, -(3 * e / 8 + 3 * e**2 / 32 + 45 * e**3 / 1024), 15 * e**2 / 256 + 45 * e**3 / 1024, -35 * e**3 / 3072)
    phi0 = math.radians(LAT0)
    origin = AXIS * (arc[0] * phi0 + sum(a * math.sin(2 * k * phi0) for k, a in enumerate(arc[1:], 1)))
    k = (1 - math.sqrt(1 - e)) / (1 + math.sqrt(1 - e))
    mu = (F.lit(origin) + (y - NORTH0) / SCALE) / (AXIS * arc[0])
    series = (3 * k / 2 - 27 * k**3 / 32, 21 * k**2 / 16 - 55 * k**4 / 32, 151 * k**3 / 96, 1097 * k**4 / 512)
    foot = mu
    for i, a in enumerate(series, 1):
        foot = foot + F.sin(mu * (2 * i)) * a
    sin2 = F.pow(F.sin(foot), 2)
    across = F.lit(AXIS) / F.sqrt(1 - sin2 * e)
    along = F.lit(AXIS * (1 - e)) / F.pow(1 - sin2 * e, 1.5)
    t, eta = F.pow(F.tan(foot), 2), F.pow(F.cos(foot), 2) * second
    d = (x - EAST0) / (across * SCALE)
    lat = foot - across * F.tan(foot) / along * (
        F.pow(d, 2) / 2
        - F.pow(d, 4) / 24 * (t * 3 + 5 + eta * 10 - F.pow(eta, 2) * 4 - 9 * second)
        + F.pow(d, 6) / 720 * (F.pow(t, 2) * 45 + t * 90 + 61 + eta * 298 - 252 * second - F.pow(eta, 2) * 3)
    )
    lon = (d - F.pow(d, 3) / 6 * (t * 2 + 1 + eta) + F.pow(d, 5) / 120 * (F.pow(t, 2) * 24 + t * 28 + 5 - eta * 2 - F.pow(eta, 2) * 3 + 8 * second)) / F.cos(foot)
    degrees = x.between(120, 140) & y.between(30, 45)
    none = x.isNull() | y.isNull()
    return F.when(~none, F.struct(F.when(degrees, y).otherwise(F.degrees(lat)).alias("lat"), F.when(degrees, x).otherwise(F.degrees(lon) + LON0).alias("lon")))


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 where either isn't one."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.get(a, F.lit(hi)), F.get(b, F.lit(hi))) - F.greatest(F.get(a, F.lit(lo)), F.get(b, F.lit(lo))))
    area = lambda x: F.greatest(F.lit(0.0), F.get(x, F.lit(2)) - F.get(x, F.lit(0))) * F.greatest(F.lit(0.0), F.get(x, F.lit(3)) - F.get(x, F.lit(1)))
    common = side(0, 2) * side(1, 3)
    return F.when((F.size(a) == 4) & (F.size(b) == 4), ratio(common, area(a) + area(b) - common)).otherwise(0.0)


def box(parts: Column) -> Column:
    """Text or numbers as a box of two places; null if any part is no number."""
    numbers = F.transform(parts, lambda p: F.round(p.try_cast("double"), 2))
    return F.when(F.forall(numbers, lambda p: p.isNotNull()), numbers)


def page_numbers(targets: Column, total: Column, most: int) -> Column:
    """The pages to read: the given ones that are positive, once each; else from 1 to the total; no more than most, if that is not 0."""
    given = F.array_distinct(F.filter(F.transform(F.coalesce(targets, F.array().cast("array<string>")), lambda p: p.try_cast("int")), lambda p: p > 0))
    n = F.coalesce(total, F.lit(0))
    count = F.when(n > 0, F.least(n, F.lit(most)) if most else n).otherwise(F.lit(max(1, most)))
    some = F.slice(given, 1, most) if most else given
    return F.when(F.size(given) > 0, some).otherwise(F.sequence(F.lit(1), count.cast("int")))


def scope(most: Column) -> Column:
    """Name of what was analysed: all pages or the first so many."""
    return F.when(F.coalesce(most, F.lit(0)) > 0, F.concat(F.lit("first_"), most.cast("string"), F.lit("_pages"))).otherwise("all_pages")
