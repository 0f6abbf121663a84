"""Text functions: Column in, Column out, inside whole-stage code where Spark has the parts."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from inkspan.functions.calls import arguments

LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
KEPT = "0-9A-Za-z가-힣"


def nz(c: Column) -> Column:
    """Null where a string is empty."""
    return F.nullif(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """The first column that is neither null nor empty; empty if none is."""
    return F.coalesce(*[nz(c) for c in cs], F.lit(""))


#: All white space of Unicode.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space, of any script, at either end. (A pattern for this would try every run of white space within.)"""
    return F.btrim(c, F.lit(SPACES))


def squash(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def tidy(c: Column) -> Column:
    """Transcript text: no blanks before a line's end, one empty line at most in a row, none at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def compact(c: Column) -> Column:
    """ASCII letters, digits and Hangul syllables only."""
    return F.regexp_replace(c, f"[^{KEPT}]", "")


def no_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


@F.pandas_udf(StringType())
def _fold(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    other = re.compile(f"[^{KEPT}]")
    for s in parts:
        yield s.map(lambda x: None if x is None else other.sub("", unicodedata.normalize("NFKC", x).casefold()))


def fold_key(c: Column) -> Column:
    """Key of a name: compatibility form, case folded, letters, digits and Hangul syllables only. ASCII text stays in the JVM."""
    ascii_only = c.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, compact(F.lower(c))).otherwise(_fold(F.when(~ascii_only, c)))


def safe_filename(c: Column) -> Column:
    return F.coalesce(nz(F.regexp_replace(F.regexp_replace(c, f"[^{KEPT}_.-]+", "_"), r"^[._]+|[._]+$", "")), F.lit("unknown"))


def similarity_key(c: Column) -> Column:
    return F.left(F.lower(F.regexp_replace(c, r"(?U)\W+", "")), F.lit(2000))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two strings, to four places."""
    return pd.Series([None if x is None or y is None else round(difflib.SequenceMatcher(None, x, y).ratio(), 4) for x, y in zip(a, b)])


def error_rate(reference: Column, candidate: Column) -> Column:
    """Struct of distance, cer, similarity, length_ratio of two texts without their white space."""
    r, c = no_space(tidy(reference)), no_space(tidy(candidate))
    distance = F.levenshtein(r, c)
    cer = distance / F.greatest(F.lit(1), F.length(r))
    return F.struct(F.length(r).alias("reference_chars"), F.length(c).alias("candidate_chars"), distance.alias("distance"), F.round(cer, 6).alias("cer"), F.round(F.greatest(F.lit(0.0), 1 - cer), 6).alias("similarity"), F.round(F.length(c) / F.greatest(F.lit(1), F.length(r)), 4).alias("length_ratio"))


#: Syllables that official Korean prose is full of.
COMMON = "".join(sorted(set("가개경고공관구국군기는다대도동등로록리면무민변별산서시신업울원은을의이재정제종주중특하한합행니따라음같청으를")))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def mojibake(c: Column) -> Column:
    """Struct of status, hangul, final_ratio, common_ratio: whether the Hangul of an extracted text looks like a broken encoding."""
    t = squash(F.coalesce(c, F.lit("")))
    hangul, cids = count_of(t, "[가-힣]"), count_of(t, r"\(cid:\d+\)")
    letters = F.filter(F.split(F.regexp_replace(t, "[^가-힣]", ""), ""), lambda x: x != "")
    final = F.size(F.filter(letters, lambda x: (F.ascii(x) - 44032) % 28 != 0)) / F.nullif(hangul, F.lit(0))
    common = count_of(t, f"[{COMMON}]") / F.nullif(hangul, F.lit(0))
    status = F.when(cids >= 5, "suspect_cid_placeholders").when(t == "", "empty").when(hangul < 50, "unknown_short_text").when((final >= 0.85) & (common <= 0.08), "suspect_mojibake").otherwise("ok")
    return F.struct(status.alias("status"), hangul.alias("hangul"), F.round(final, 4).alias("final_ratio"), F.round(common, 4).alias("common_ratio"))


def readability(c: Column) -> Column:
    """Class of a page's text: empty_or_sparse, suspect_or_encoded or readable."""
    t = no_space(F.coalesce(c, F.lit("")))
    n = F.length(t)
    odd = count_of(t, r"(?U)[^\x00-\x7F가-힣ᄀ-ᇿ㄰-㆏一-鿿·ㆍ℃㎞㎡㎥％]")
    fine = count_of(t, f"[{KEPT}]")
    return F.when(n < 20, "empty_or_sparse").when(F.contains(F.lower(t), F.lit("(cid:")), "suspect_or_encoded").when((odd / n >= 0.2) & (fine / n < 0.55), "suspect_or_encoded").otherwise("readable")


def filled_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), LINE_BREAK), strip), lambda x: x != "")


def transcript_quality(df: DataFrame, text: str, name: str = "quality") -> DataFrame:
    """df with a struct of counts and ratios of a transcript, and whether it is suspect. The tidy text and its lines are made once, in projections of their own."""
    made = df.withColumn("__t", tidy(F.coalesce(F.col(text), F.lit("")))).withColumn("__lines", filled_lines(F.col("__t")))
    return made.withColumn(name, _quality(F.col("__t"), F.col("__lines"))).drop("__t", "__lines")


def _quality(t: Column, lines: Column) -> Column:
    chars, spaces, hangul = F.length(t), count_of(t, r"(?U)\s"), count_of(t, "[가-힣]")
    repeated = F.coalesce(1 - F.size(F.array_distinct(lines)) / F.nullif(F.size(lines), F.lit(0)), F.lit(0.0))
    share = hangul / F.greatest(F.lit(1), chars - spaces)
    lost, cids = count_of(t, "�"), count_of(t, r"\(cid:")
    hidden = count_of(t, r"[\p{C}&&[^\s\x1c-\x1f\x85]]")
    suspect = (chars == 0) | (lost > 0) | (cids > 0) | ((chars >= 100) & (share < 0.05)) | (repeated > 0.45)
    return F.struct(
        chars.alias("chars"), F.size(lines).alias("lines"), hangul.alias("hangul_chars"), count_of(t, r"[一-鿿]").alias("hanja_chars"), count_of(t, r"\p{Nd}").alias("digits"),
        F.round(share, 4).alias("hangul_ratio"), F.round((chars - hidden) / F.greatest(F.lit(1), chars), 4).alias("printable_ratio"), lost.alias("replacement_chars"), cids.alias("cid_markers"), F.round(repeated, 4).alias("duplicate_line_ratio"), suspect.alias("suspect"),
    )


def form_score(c: Column) -> Column:
    """Share of the filled lines that look like a form's: a label with a value, an enumerator, or a dash or middle dot."""
    lines = filled_lines(c)
    like = lambda x: x.rlike(r"(?U)[:：]\s*\S") | x.rlike(f"(?U)^[{KEPT}][.)]\\s") | F.contains(x, F.lit(" - ")) | x.rlike("[ㆍ·]")
    return F.coalesce(F.size(F.filter(lines, like)) / F.nullif(F.size(lines), F.lit(0)), F.lit(0.0))


def address(c: Column) -> Column:
    """A Korean address without postal prefix, zero-width marks and commas, with tidy blanks and brackets."""
    t = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"[​-‏﻿]", "")
    t = F.regexp_replace(t, r"(?U)^\s*(\(?[0-9]{5}\)?|\[[0-9]{5}\]|[0-9]{3}-[0-9]{3})\s+", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)\s*,\s*", " "), r"(?U)\s+", " ")
    return strip(F.regexp_replace(F.regexp_replace(t, r" +([),])", "$1"), r"\( +", "("))


_NAME = "[가-힣A-Za-z0-9·.-]+"


def address_type(c: Column) -> Column:
    """road, jibun (land lot) or unknown."""
    t = F.concat(F.lit(" "), address(c), F.lit(" "))
    road = t.rlike(rf"(?U)\s{_NAME}(로|길)\s+\d+(-\d+)?[\s,)]")
    lot = t.rlike(rf"(?U)\s{_NAME}[읍면동리가]\s+(산\s*)?\d")
    return F.when(road, "road").when(lot, "jibun").otherwise("unknown")


def keyword_error(c: Column) -> Column:
    """Why an address cannot be searched for: empty, short, long, digits, characters; null if it can."""
    t = address(c)
    return F.when(t == "", "empty").when(F.length(t) < 2, "short").when(F.length(t) > 80, "long").when(t.rlike(r"^\p{Nd}+$"), "digits").when(t.rlike(r"[\[\]<>=%]"), "characters")


def title_needles(c: Column) -> Column:
    """What to look for in a page's compact text to find a title: its numbered head, the part before a bracket, the whole; eight characters at least."""
    t = F.coalesce(c, F.lit(""))
    head = F.regexp_extract(t, r"(?U)^(.+?제\s*\d{4}\s*[-–]\s*\d+\s*호)", 1)
    parts = F.array(head, F.element_at(F.split(t, r"[(<〈]", 2), 1), t)
    return F.array_distinct(F.filter(F.transform(parts, compact), lambda x: F.length(x) >= 8))


def call_arguments(c: Column, name: str = "fnDetail") -> Column:
    @F.pandas_udf(ArrayType(StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: arguments(x, name))

    return run(c)


def query_value(url: Column, key: str) -> Column:
    """The first value of a query parameter, decoded; null where it is missing or blank."""
    plain = F.replace(url, F.lit("&amp;"), F.lit("&"))
    return nz(F.try_url_decode(F.regexp_extract(plain, rf"[?&]{re.escape(key)}=([^&#]*)", 1)))


def viewer_url(base: str, path: Column) -> Column:
    return F.when(path.rlike("^https?://"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(path, "^/+", "")))


def masked(c: Column) -> Column:
    """A secret's first six and last four characters; nothing of one of up to ten."""
    return F.when(F.length(c) <= 10, "***").otherwise(F.concat(F.left(c, F.lit(6)), F.lit("..."), F.right(c, F.lit(4))))


def model_id(c: Column, drop_dash: bool) -> Column:
    return F.regexp_replace(F.lower(c), "qwen-", "qwen") if drop_dash else c


def csv_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")


def duration(seconds: Column) -> Column:
    """1h02m, 2m03s, 5s, or - where there is none."""
    s = F.bround(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(seconds.isNull() | (seconds < 0), "-").when(h > 0, F.format_string("%dh%02dm", h, m)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def any_marker(c: Column, markers: list[str]) -> Column:
    """Whether a text holds any of the markers."""
    return c.rlike("|".join("\\Q" + m + "\\E" for m in markers))


_LOST = ["Connection reset by peer", "socket hang up", "HTTP 401", "HTTP 403", *(f"HTTP 50{d}" for d in "023")]
SESSION_MARKERS = sorted([*_LOST, "Server disconnected", "result is not a PDF", "result is not a complete PDF", "no download endpoint", "no session left"])
TRANSFER_MARKERS = sorted([*_LOST, "ENETUNREACH", "Network is unreachable", "TransferEncodingError", "ContentLengthError", "invalid literal for int() with base 16", "Not enough data"])
RATE_MARKERS = sorted(["rate limit", "ratelimit", "quota", "too many requests", "resourceexhausted", "throttl"])


def failure_kind(error: Column) -> Column:
    """rate_limit, session, transfer or other, by what an error's text holds."""
    return F.when(any_marker(F.lower(error), RATE_MARKERS) | error.rlike(r"\b429\b"), "rate_limit").when(any_marker(error, SESSION_MARKERS), "session").when(any_marker(error, TRANSFER_MARKERS), "transfer").otherwise("other")
