"""Structs, maps, arrays and JSON."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkspan.functions.text import nz


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is evaluated once, however often f names it. (No Python function may be within f.)"""
    return F.transform(F.array(c), f)[0]


def overlay(defaults: Column, current: Column) -> Column:
    """A map of defaults overlaid by current, without blank values."""
    kept = F.map_filter(defaults, lambda k, _: ~F.coalesce(F.map_contains_key(current, k), F.lit(False)))
    return without_blanks(F.coalesce(F.map_concat(kept, current), kept))


def without_blanks(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v.isNotNull() & (v != ""))


def with_defaults(struct: Column, defaults: dict[str, Column]) -> Column:
    """A struct whose null fields are filled; dotted names reach into structs."""
    out = struct
    for name, value in defaults.items():
        at = struct
        for part in name.split("."):
            at = at[part]
        out = out.withField(name, F.coalesce(at, value))
    return out


def flatten(df: DataFrame, *structs: str) -> DataFrame:
    """Each struct's fields as columns prefixed by its name; maps and arrays as JSON."""
    out = []
    for field in df.schema.fields:
        if field.name in structs:
            for inner in field.dataType.fields:
                c = F.col(f"`{field.name}`.`{inner.name}`")
                out.append((F.to_json(c) if inner.dataType.typeName() in ("map", "array", "struct") else c).alias(f"{field.name}_{inner.name}"))
        else:
            c = F.col(f"`{field.name}`")
            out.append((F.to_json(c) if field.dataType.typeName() in ("map", "array", "struct") else c).alias(field.name))
    return df.select(out)


def first_path(c: Column, *paths: str) -> Column:
    """The first of JSON paths that holds text."""
    return F.coalesce(*[nz(F.trim(F.get_json_object(c, p))) for p in paths])


REFERENCE_PATHS = tuple("$." + p for p in "peers.agy_cli.corrected_text consensus.corrected_text ocr.text primary_text corrected_text text".split())


def _objects(text: str) -> Iterator[dict]:
    read, at = json.JSONDecoder(), -1
    while (at := text.find("{", at + 1)) >= 0:
        try:
            value = read.raw_decode(text, at)[0]
        except (ValueError, RecursionError):
            continue
        if isinstance(value, dict):
            yield value


def loose_object(text: str | None) -> str | None:
    """The JSON object in a model's answer, as JSON: all of it, within a code fence, or the last that holds a verdict or text."""
    t = (text or "").strip()
    if t.startswith("```"):
        t = t.partition("\n")[2].strip().removesuffix("```").strip()
    try:
        whole = json.loads(t)
        return json.dumps(whole, ensure_ascii=False) if isinstance(whole, dict) else None
    except (ValueError, RecursionError):
        found = list(_objects(t))
    good = [x for x in found if "text" in x or {"verdict", "corrected_text"}.issubset(x)]
    best = (good or found or [None])[-1]
    return None if best is None else json.dumps(best, ensure_ascii=False)


@F.pandas_udf(StringType())
def _loose(s: pd.Series) -> pd.Series:
    return s.map(loose_object)


def json_object(c: Column) -> Column:
    """JSON text of the object in a loose answer; text that is JSON already stays in the JVM."""
    # only what begins as an object can be one; a failed parse costs an exception
    begins = F.startswith(F.ltrim(c, F.lit(" \t\r\n")), F.lit("{"))
    strict = once(F.try_parse_json(F.when(begins, c)), lambda plain: F.when(F.schema_of_variant(plain).startswith("OBJECT"), F.to_json(plain)))
    return F.coalesce(strict, _loose(F.when(strict.isNull(), c)))


def as_list(c: Column, separator: str = ">") -> Column:
    """Text split at a separator, trimmed, without blanks; null and empty text as an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


@F.pandas_udf(StringType())
def _search(payload: pd.Series, key: pd.Series) -> pd.Series:
    def walk(value, wanted):
        stack = [value]
        while stack:
            value = stack.pop()
            if isinstance(value, dict):
                if isinstance(value.get(wanted), list) and value[wanted]:
                    return value[wanted]
                value = list(value.values())
            if isinstance(value, list):
                stack.extend(reversed(value))
        return None

    def one(text, wanted):
        try:
            hit = walk(json.loads(text), wanted)
        except (TypeError, ValueError, RecursionError):  # deeper than the parser goes
            return None
        return None if hit is None else json.dumps(hit, ensure_ascii=False)

    return pd.Series([one(t, k) for t, k in zip(payload, key)])


def find_list(c: Column, key: str) -> Column:
    """The first non-empty list under a key at any depth, depth first, as JSON."""
    return _search(c, F.lit(key))


@F.pandas_udf(StringType())
def _korean(body: pd.Series) -> pd.Series:
    return body.map(lambda b: None if b is None else bytes(b).decode("cp949", "replace"))


def decoded(body: Column, content_type: Column) -> Column:
    """The text of a response body, by its declared character set; Spark itself decodes no Korean one."""
    korean = F.lower(F.coalesce(content_type, F.lit(""))).rlike("euc-?kr|ks_c_5601|cp949")
    return F.when(korean, _korean(F.when(korean, body))).otherwise(F.decode(F.when(~korean, body), "UTF-8"))


def cookies(c: Column, domain: str) -> Column:
    """Cookies (structs of name, value, domain, path) without blank names or values, with default domain and path."""
    good = F.filter(c, lambda x: nz(x["name"]).isNotNull() & nz(x["value"]).isNotNull())
    return F.transform(good, lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"), F.coalesce(nz(x["domain"]), F.lit(domain)).alias("domain"), F.coalesce(nz(x["path"]), F.lit("/")).alias("path")))


def session_id(c: Column) -> Column:
    return F.get(F.filter(c, lambda x: F.upper(x["name"]) == "JSESSIONID"), F.lit(0))["value"]
