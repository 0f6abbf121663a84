import datetime as dt
import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from inkspan.functions import dates as D
from inkspan.functions import nested as N
from inkspan.functions import numbers as M
from inkspan.functions import text as T


def col(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, f, values, kind="string"):
    return [r.y for r in col(spark, values, kind).select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_white_space_of_any_script(spark):
    assert apply(spark, T.squash, ["  a　b \t\nc ", None, "   "]) == ["a b c", None, ""]
    assert apply(spark, T.tidy, ["a  \nb\n\n\n\nc\n ", ""]) == ["a\nb\n\nc", ""]


def test_keys_and_names(spark):
    rng = random.Random(1)
    texts = ["서울특별시 중구 공고", "ＡＢＣ １２", "Straße ﬁ", "", "a-b_c"] + ["".join(rng.choice("aZ9 -가힣ｶ①ß") for _ in range(12)) for _ in range(30)]
    want = [re.sub("[^0-9A-Za-z가-힣]", "", unicodedata.normalize("NFKC", t).casefold()) for t in texts]
    assert apply(spark, T.fold_key, [*texts, None]) == [*want, None]
    assert apply(spark, T.safe_filename, ["a/b:c", "..x..", "///", "고시 1"]) == ["a_b_c", "x", "unknown", "고시_1"]


def test_mojibake_classes(spark):
    fine = "서울특별시 공고 제정 시행합니다 주민등록 " * 6
    broken = "뷁쉙궳뉅" * 30
    got = apply(spark, T.mojibake, [fine, broken, "(cid:1)" * 5, "", "짧다", None])
    assert [g.status for g in got] == ["ok", "suspect_mojibake", "suspect_cid_placeholders", "empty", "unknown_short_text", "empty"]
    assert got[1].final_ratio == 1.0 and got[0].hangul > 100


def test_readability_and_forms(spark):
    assert apply(spark, T.readability, ["short", "ÀÁÂÃÄÅ" * 10, "plain readable words here", "text (CID:7) " * 3, None]) == ["empty_or_sparse", "suspect_or_encoded", "readable", "suspect_or_encoded", "empty_or_sparse"]
    assert apply(spark, T.form_score, ["name: x\n1. one\nplain\n\na - b", "", "성명：값\nㆍ점"]) == [0.75, 0.0, 1.0]


def test_transcript_quality(spark):
    q = apply(spark, lambda c: T._quality(T.tidy(c), T.filled_lines(T.tidy(c))), ["가나다 漢字 12\n가나다 漢字 12\n", "x" * 100, "ok �", ""])
    assert (q[0].lines, q[0].hanja_chars, q[0].digits, q[0].duplicate_line_ratio, q[0].suspect) == (2, 4, 4, 0.5, True)
    assert [x.suspect for x in q] == [True, True, True, True] and q[2].replacement_chars == 1


def test_error_rate_against_brute_force(spark):
    def brute(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(2)
    pairs = [("".join(rng.choice("ab c가\n") for _ in range(rng.randrange(15))), "".join(rng.choice("ab c가\n") for _ in range(rng.randrange(15)))) for _ in range(40)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in df.select("i", T.error_rate(F.col("a"), F.col("b")).alias("m")).collect():
        a, b = ("".join(x.split()) for x in pairs[r.i])
        assert r.m.distance == brute(a, b) and r.m.cer == round(brute(a, b) / max(1, len(a)), 6)


def test_similarity_is_the_matching_ratio(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("", ""), ("x", None)], "a string, b string")
    got = [r.s for r in df.select(T.similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[:2] == [round(SequenceMatcher(None, "abcd", "bcde").ratio(), 4), 1.0] and got[2] is None


def test_addresses(spark):
    raw = ["(04524) 서울특별시 중구 세종대로 110 ( 태평로1가 )", "  서울 , 종로구 청운동 산 12-3번지", "03000", "가", "서울%"]
    assert apply(spark, T.address, raw)[0] == "서울특별시 중구 세종대로 110 (태평로1가)"
    assert apply(spark, T.address_type, raw)[:3] == ["road", "jibun", "unknown"]
    assert apply(spark, T.keyword_error, [*raw, "", "x" * 81]) == [None, None, "digits", "short", "characters", "empty", "long"]


def test_needles_arguments_queries(spark):
    assert apply(spark, T.title_needles, ["환경부고시 제2024-12호 (수질 기준)", "짧다", None]) == [["환경부고시제202412호", "환경부고시제202412호수질기준"], [], []]
    calls = ["fnDetail('a,b','it\\'s',\"q)\", 7, null)", "other('x')", None, "x=fnDetail()", "fnDetail('&lt;b&gt;','',f(1,2))"]
    assert apply(spark, T.call_arguments, calls) == [["a,b", "it's", "q)", "7", ""], [], [], [], ["<b>", "", "f(1,2)"]]
    urls = ["/v?contentId=C%201&amp;tocId=T1", "/v?tocId=", "/v", None]
    assert apply(spark, lambda c: T.query_value(c, "contentId"), urls) == ["C 1", None, None, None]
    assert apply(spark, T.csv_parts, [" a, ,b ,", ""]) == [["a", "b"], []]
    assert apply(spark, T.masked, ["0123456789", "0123456789a"]) == ["***", "012345...789a"]
    assert apply(spark, lambda c: T.model_id(c, True), ["Qwen-2.5-VL"]) == ["qwen2.5-vl"]


def test_durations(spark):
    assert apply(spark, T.duration, [None, -1.0, 4.6, 123.0, 3720.0], "double") == ["-", "-", "5s", "2m03s", "1h02m"]


def test_dates(spark):
    assert apply(spark, D.normalize, ["2024-1-2", "2024.01.02", "2024/1/2", "20240102", "2024.13.40", "no/date", None]) == ["2024-01-02"] * 4 + ["2024-13-40", "no-date", ""]
    assert apply(spark, lambda c: D.from_parts(F.lit(None), F.lit(None), F.lit(None), c), ["20240508", "2024050", None]) == ["2024-05-08", "2024050", ""]
    assert [tuple(x) for x in apply(spark, lambda c: D.date_parts(c, F.lit("20240203")), ["2024-05-06T00", "", "2023"])] == [("2024", "20240506"), ("2024", "20240203"), ("2024", "20240203")]
    assert apply(spark, D.prefix_date, ["2024-02-30", "2024-02-29xyz", "x"]) == [None, dt.date(2024, 2, 29), None]
    assert apply(spark, lambda c: D.zfill(c, 2), ["1", "123", ""]) == ["01", "123", "00"]
    with pytest.raises(Exception, match="not a date"):
        apply(spark, D.date_or_raise, ["soon"])
    assert apply(spark, D.parse_stamp, ["2024-01-02T03:04:05Z", "bad", ""])[1:] == [None, None]


def test_windows_and_batches(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 29), dt.date(2024, 3, 1))], "a date, b date")
    b = df.select(D.year_batches(F.col("a"), F.col("b"), 1).alias("x")).first().x
    assert [tuple(x) for x in b][:2] == [(dt.date(2020, 2, 29), dt.date(2021, 2, 27)), (dt.date(2021, 2, 28), dt.date(2022, 2, 27))] and b[-1].batch_end == dt.date(2024, 3, 1)
    w = df.select(D.windows(F.col("a"), F.col("b")).alias("x")).first().x
    assert all((x.window_end - x.window_start).days == 30 for x in w[:-1]) and w[-1].window_end == dt.date(2024, 3, 1)
    assert all(p.window_end + dt.timedelta(1) == q.window_start for p, q in zip(w, w[1:]))
    with pytest.raises(Exception, match="ends before"):
        df.select(D.year_batches(F.col("b"), F.col("a"), 1)).collect()
    with pytest.raises(ValueError):
        D.year_batches(F.col("a"), F.col("b"), 0)


def test_inferred_validity(spark):
    df = spark.createDataFrame([("4211", ""), ("5111", "x"), ("", "강원특별자치도 춘천시"), ("3611", "세종특별자치시"), ("11", "서울")], "c string, n string")
    got = [tuple(r.v) for r in df.select(D.inferred_validity(F.col("c"), F.col("n")).alias("v")).collect()]
    assert got == [(None, dt.date(2023, 6, 10)), (dt.date(2023, 6, 11), None), (dt.date(2023, 6, 11), None), (dt.date(2012, 7, 1), None), (None, None)]


def test_numbers(spark):
    assert apply(spark, M.admin_level, ["1100000000", "1111000000", "1111010100", "1111010101", "11", None]) == ["sido", "sigungu", "eupmyeondong", "ri", "unknown", "unknown"]
    assert apply(spark, M.admin_code, ["11", "11110", "1111010100", None]) == ["1100000000", "1111000000", "1111010100", ""]
    assert apply(spark, M.unit, ["0.5", "7", "-1", "x", None]) == [0.5, 1.0, 0.0, 0.0, 0.0]
    assert apply(spark, lambda c: M.page_numbers(c, F.lit(9), 1), [["187", "187", "bad", "0", "188"], None, []], "array<string>") == [[187], [1], [1]]
    assert apply(spark, lambda c: M.page_numbers(c, F.lit(9), 0), [["187", "187", "bad", "0", "188"], None], "array<string>") == [[187, 188], list(range(1, 10))]
    assert apply(spark, M.box, [["1.234", "2", "3", "4"], ["x", "1", "1", "1"]], "array<string>") == [[1.23, 2.0, 3.0, 4.0], None]
    assert apply(spark, lambda c: M.overlap(c, F.array(*map(F.lit, (0.0, 0.0, 2.0, 2.0)))), [[1.0, 1.0, 3.0, 3.0], [5.0, 5.0, 6.0, 6.0], None], "array<double>") == [pytest.approx(1 / 7), 0.0, 0.0]
    assert apply(spark, M.scope, [None, 0, 3], "int") == ["all_pages", "all_pages", "first_3_pages"]


def test_grid_coordinates(spark):
    df = spark.createDataFrame([(953177.123, 1952056.456), (127.1, 37.2), (None, 1.0), (1000000.0, 2000000.0)], "x double, y double")
    g = [r.g for r in df.select(M.wgs84(F.col("x"), F.col("y")).alias("g")).collect()]
    assert 37.5 < g[0].lat < 37.7 and 126.8 < g[0].lon < 127.1
    assert (g[1].lat, g[1].lon) == (37.2, 127.1) and g[2] is None
    assert g[3].lat == pytest.approx(38, abs=1e-9) and g[3].lon == pytest.approx(127.5, abs=1e-9)


def test_nested(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "", "c": "3"})], "d map<string,string>, c map<string,string>")
    assert df.select(N.overlay(F.col("d"), N.without_blanks(F.col("c"))).alias("m")).first().m == {"a": "1", "b": "2", "c": "3"}
    loose = ['{"n":1}', '```json\n{"n":2}\n```', 'x {"a":1} y {"verdict":"a","corrected_text":"t","n":3} {"z":1}', "{bad {\"n\":4}", "none", "[1]", None]
    assert apply(spark, lambda c: F.get_json_object(N.json_object(c), "$.n"), loose) == ["1", "2", "3", "4", None, None, None]
    assert apply(spark, N.as_list, ["a > b>", None]) == [["a", "b"], []]
    assert apply(spark, lambda c: N.find_list(c, "k"), ['{"a":{"k":[]},"b":[{"k":[1]}]}', "bad", None]) == ["[1]", None, None]
    body = spark.createDataFrame([(bytearray("가".encode("euc-kr")), "text/html; charset=EUC-KR"), (bytearray("가".encode()), None)], "b binary, t string")
    assert [r.x for r in body.select(N.decoded(F.col("b"), F.col("t")).alias("x")).collect()] == ["가", "가"]
    jar = spark.createDataFrame([([("JSESSIONID", "s", None, ""), ("", "x", "d", "/")],)], "c array<struct<name string, value string, domain string, path string>>")
    r = jar.select(N.cookies(F.col("c"), "host").alias("c"), N.session_id(F.col("c")).alias("s")).first()
    assert [tuple(x) for x in r.c] == [("JSESSIONID", "s", "host", "/")] and r.s == "s"
    st = spark.createDataFrame([((None, ("x", None)),)], "s struct<a string, b struct<c string, d string>>")
    filled = st.select(N.with_defaults(F.col("s"), {"a": F.lit("A"), "b.d": F.lit("D")}).alias("s")).first().s
    assert (filled.a, filled.b.c, filled.b.d) == ("A", "x", "D")
