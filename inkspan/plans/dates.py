"""Dates, windows, codes and coordinates of orders, nations and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.functions import dates as D
from inkspan.functions import numbers as M
from inkspan.registry import query
from inkspan.session import table

FORMATS = ("yyyy-MM-dd", "yyyy.MM.dd", "yyyy/M/d", "yyyyMMdd", "'n/a' yyyy.MM")


@query("""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y.%m.%d') WHEN 2 THEN strftime(o_orderdate, '%Y/%-m/%-d') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, 'n/a %Y.%m') END AS raw, o_orderdate FROM orders)
    SELECT o_orderkey, raw, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE replace(replace(raw, '.', '-'), '/', '-') END AS date FROM d""")
def date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.lit(None).cast("string")
    for i, f in enumerate(FORMATS):
        raw = F.when(F.col("o_orderkey") % 5 == i, F.date_format("o_orderdate", f)).otherwise(raw)
    return table(spark, sf_dir, "orders").withColumn("raw", raw).select("o_orderkey", "raw", D.normalize(F.col("raw")).alias("date"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y') END AS date FROM orders""")
def ymd_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From year, month, day; else the registration date; else what there is."""
    k = F.col("o_orderkey") % 3
    part = lambda f, n: F.when(k == n, F.date_format("o_orderdate", f)).otherwise("")
    year = F.when(k != 1, F.date_format("o_orderdate", "yyyy")).otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", D.from_parts(year, part("M", 0), part("d", 0), F.when(k == 1, F.date_format("o_orderdate", "yyyyMMdd"))).alias("date"))


@query("""WITH c AS (SELECT o_custkey, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1), w AS (SELECT o_custkey, b, a + unnest(range(0, (b - a)::BIGINT + 1, 31))::INTEGER AS s FROM c)
    SELECT o_custkey, s AS window_start, least(s + 30, b) AS window_end FROM w""")
def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 31 days over each customer's orders."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return c.select("o_custkey", F.inline(D.windows(F.col("a"), F.col("b"))))


@query("""WITH c AS (SELECT o_custkey, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1), w AS (SELECT o_custkey, b, a, unnest(range(0, 20)) AS k FROM c)
    SELECT o_custkey, (a + to_years(2 * k::INTEGER))::DATE AS batch_start, least((a + to_years(2 * k::INTEGER + 2))::DATE - 1, b) AS batch_end FROM w WHERE (a + to_years(2 * k::INTEGER))::DATE <= b""")
def year_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two years over each customer's orders."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return c.select("o_custkey", F.inline(D.year_batches(F.col("a"), F.col("b"), 2)))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'not_versioned' WHEN o_custkey % 4 <> 1 AND o_orderdate::DATE < DATE '1997-01-01' THEN 'before_validity' WHEN o_custkey % 4 <> 2 AND o_orderdate::DATE > DATE '1999-12-31' THEN 'after_validity' ELSE 'in_validity' END AS relation FROM orders""")
def validity_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey") % 4
    return table(spark, sf_dir, "orders").select("o_orderkey", D.validity(F.to_date("o_orderdate"), F.when(k.isin(2, 3), F.lit("1997-01-01").cast("date")), F.when(k.isin(1, 3), F.lit("1999-12-31").cast("date"))).alias("relation"))


@query("""WITH n AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN (n_nationkey + 10)::VARCHAR WHEN 1 THEN (n_nationkey + 10100)::VARCHAR WHEN 2 THEN (n_nationkey + 10)::VARCHAR || '11010100' ELSE (n_nationkey + 10)::VARCHAR || '11010123' END AS raw FROM nation),
    c AS (SELECT n_nationkey, CASE WHEN length(raw) IN (2, 5) THEN rpad(raw, 10, '0') ELSE raw END AS code FROM n)
    SELECT n_nationkey, code, CASE WHEN code[3:] = '00000000' THEN 'sido' WHEN code[6:] = '00000' THEN 'sigungu' WHEN code[9:] = '00' THEN 'eupmyeondong' ELSE 'ri' END AS level FROM c""")
def admin_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("n_nationkey") % 4, (F.col("n_nationkey") + 10).cast("string")
    raw = F.when(k == 0, s).when(k == 1, (F.col("n_nationkey") + 10100).cast("string")).when(k == 2, F.concat(s, F.lit("11010100"))).otherwise(F.concat(s, F.lit("11010123")))
    return table(spark, sf_dir, "nation").select("n_nationkey", M.admin_code(raw).alias("code")).withColumn("level", M.admin_level(F.col("code")))


SQL_GRID = """WITH s AS (SELECT s_suppkey, 900000 + s_acctbal * 15 AS x, 1700000 + s_nationkey * 20000 AS y FROM supplier), k AS (SELECT 2 / 298.257222101 - power(1 / 298.257222101, 2) AS e),
    c AS (SELECT e, e / (1 - e) AS e2, 6378137.0 * (1 - e/4 - 3*e*e/64 - 5*e*e*e/256) AS a1, (1 - sqrt(1 - e)) / (1 + sqrt(1 - e)) AS k, radians(38.0) AS p FROM k),
    o AS (SELECT *, 6378137.0 * ((1 - e/4 - 3*e*e/64 - 5*e*e*e/256) * p - (3*e/8 + 3*e*e/32 + 45*e*e*e/1024) * sin(2*p) + (15*e*e/256 + 45*e*e*e/1024) * sin(4*p) - 35*e*e*e/3072 * sin(6*p)) AS m0 FROM c),
    m AS (SELECT s.*, o.*, (m0 + (y - 2000000) / 0.9996) / a1 AS mu FROM s, o),
    f AS (SELECT *, mu + (3*k/2 - 27*k*k*k/32)*sin(2*mu) + (21*k*k/16 - 55*k*k*k*k/32)*sin(4*mu) + 151*k*k*k/96*sin(6*mu) + 1097*k*k*k*k/512*sin(8*mu) AS phi FROM m),
    r AS (SELECT *, 6378137.0 / sqrt(1 - e*sin(phi)*sin(phi)) AS n, 6378137.0*(1 - e) / power(1 - e*sin(phi)*sin(phi), 1.5) AS q, tan(phi)*tan(phi) AS t, e2*cos(phi)*cos(phi) AS h FROM f), d AS (SELECT *, (x - 1000000) / (n * 0.9996) AS d FROM r)"""


@query(SQL_GRID + """ SELECT s_suppkey, round(degrees(phi - n*tan(phi)/q * (d*d/2 - (5 + 3*t + 10*h - 4*h*h - 9*e2)*power(d,4)/24 + (61 + 90*t + 298*h + 45*t*t - 252*e2 - 3*h*h)*power(d,6)/720)), 7) AS lat,
    round(127.5 + degrees((d - (1 + 2*t + h)*power(d,3)/6 + (5 - 2*h + 28*t - 3*h*h + 8*e2 + 24*t*t)*power(d,5)/120) / cos(phi)), 7) AS lon FROM d""")
def grid_to_wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latitude and longitude of unified-grid coordinates made of suppliers' numbers."""
    x, y = F.col("s_acctbal") * 15 + 900000, (F.col("s_nationkey") * 20000 + 1700000).cast("double")
    return table(spark, sf_dir, "supplier").select("s_suppkey", M.wgs84(x, y).alias("g")).select("s_suppkey", F.round("g.lat", 7).alias("lat"), F.round("g.lon", 7).alias("lon"))
