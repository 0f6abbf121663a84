"""Dates and windows of dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspan.functions.text import first_filled, nz, strip


def normalize(c: Column) -> Column:
    """yyyy-MM-dd from dashes, dots, slashes or eight digits; other text with dots and slashes as dashes."""
    t = strip(F.coalesce(c, F.lit("")))
    parsed = F.coalesce(*[F.try_to_timestamp(F.when(t.rlike(p), t), F.lit(f)) for p, f in ((r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{8}$", "yyyyMMdd"))])
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.translate(t, "./", "--"))


def eight_digits(c: Column) -> Column:
    """The ISO date of eight digits that are one, else null."""
    return F.date_format(F.try_to_timestamp(F.when(c.rlike("^[0-9]{8}$"), c), F.lit("yyyyMMdd")), "yyyy-MM-dd")


def from_parts(year: Column, month: Column, day: Column, registered: Column) -> Column:
    """From year, month and day; else from the registration date; else what there is of either, as it is."""
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (year, month, day)]
    joined = F.concat(parts[0], *[zfill(x, 2) for x in parts[1:]])
    return F.coalesce(eight_digits(joined), eight_digits(registered), first_filled(F.concat(*parts), F.coalesce(registered, F.lit(""))))


def zfill(c: Column, width: int) -> Column:
    """Zeros in front up to a width; longer text stays whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def date_parts(date: Column, registered: Column) -> Column:
    """Struct of year and date_key (yyyymmdd), unknown where neither date is one."""
    iso = F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(date, F.lit(10)))
    key = F.coalesce(F.replace(iso, F.lit("-"), F.lit("")), F.when(registered.rlike("^[0-9]{8}$"), registered))
    year = F.coalesce(F.left(key, F.lit(4)), F.when(date.rlike(r"^\d{4}"), F.left(date, F.lit(4))), F.lit("unknown"))
    return F.struct(year.alias("year"), F.coalesce(key, F.lit("unknown")).alias("date_key"))


def prefix_date(c: Column) -> Column:
    """The date that the first ten characters are, else null."""
    return F.try_to_timestamp(F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(c, F.lit(10))), F.lit("yyyy-MM-dd")).cast("date")


def date_or_raise(c: Column) -> Column:
    """The date; today for "today"; an error otherwise."""
    t = normalize(c)
    return F.when(F.lower(strip(c)) == "today", F.current_date()).when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), prefix_date(t)).otherwise(F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date"))


def windows(start: Column, end: Column, days: int = 31) -> Column:
    """Array of (window_start, window_end), both inclusive; the last ends with the range."""
    starts = F.sequence(start, F.greatest(start, end), F.expr(f"interval {days} days"))
    return F.filter(F.transform(starts, lambda s: F.struct(s.alias("window_start"), F.least(F.date_add(s, days - 1), end).alias("window_end"))), lambda w: w["window_start"] <= end)


def year_batches(start: Column, end: Column, years: int) -> Column:
    """Array of (batch_start, batch_end) of so many years; the 29th of February becomes the 28th where it must. Raises for a range that ends before it starts."""
    if years < 1:
        raise ValueError("a batch needs a year at least")
    n = F.floor(F.months_between(F.greatest(start, end), start) / (12 * years)).cast("int")
    each = F.transform(F.sequence(F.lit(0), n), lambda k: F.struct(F.add_months(start, k * 12 * years).alias("batch_start"), F.least(F.date_sub(F.add_months(start, (k + 1) * 12 * years), 1), end).alias("batch_end")))
    kept = F.filter(each, lambda b: b["batch_start"] <= end)
    return F.when(start > end, F.raise_error(F.lit("the range ends before it starts"))).otherwise(kept)


def iso_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_stamp(c: Column) -> Column:
    """A timestamp from ISO text, with or without Z, else null."""
    return F.try_to_timestamp(nz(c))


def validity(published: Column, valid_from: Column, valid_to: Column) -> Column:
    """How a date lies to a range with open ends: unknown, before_validity, after_validity, in_validity or not_versioned."""
    return F.when(published.isNull(), "unknown").when(published < valid_from, "before_validity").when(published > valid_to, "after_validity").when(valid_from.isNotNull() | valid_to.isNotNull(), "in_validity").otherwise("not_versioned")


#: (code prefix, name prefix, first day, last day) of provinces that were renamed.
RENAMED = [
    ("49", "제주도", None, "2006-06-30"), ("50", "제주특별자치도", "2006-07-01", None),
    ("42", "강원도", None, "2023-06-10"), ("51", "강원특별자치도", "2023-06-11", None),
    ("45", "전라북도", None, "2024-01-17"), ("52", "전북특별자치도", "2024-01-18", None),
    (None, "세종특별자치시", "2012-07-01", None),
]


def inferred_validity(code: Column, name: Column) -> Column:
    """Struct of valid_from and valid_to that a place's code or name implies; by code first."""
    found = F.lit(None).cast("struct<valid_from:date,valid_to:date>")
    ranges = [(c, n, F.struct(F.lit(a).cast("date").alias("valid_from"), F.lit(b).cast("date").alias("valid_to"))) for c, n, a, b in RENAMED]
    for c, n, r in reversed(sorted(ranges, key=lambda x: (x[0] is None, str(x[0])))):
        rule = F.startswith(name, F.lit(n)) if c is None else F.startswith(code, F.lit(c)) | F.startswith(name, F.lit(n))
        found = F.when(rule, r).otherwise(found)
    return F.coalesce(found, F.struct(F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")))
