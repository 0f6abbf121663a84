"""List pages, search answers, viewer links and address answers, made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.functions import nested as N
from inkspan.functions import text as T
from inkspan.operators import items as I
from inkspan.registry import query
from inkspan.session import table
from inkspan.sources import feeds as S


@query(r"""WITH h AS (SELECT page_id, coalesce(html, '') AS h FROM pages)
    SELECT page_id, trim(regexp_replace(regexp_extract(h, '<title>(.*?)</title>', 1, 'si'), '\s+', ' ', 'g'), ' ') AS title, len(regexp_extract_all(h, '<a href="([^"]*)"', 1))::INTEGER AS n_links, regexp_extract_all(h, '<a href="([^"]*)"', 1)[1] AS first_link,
        length(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '<script\b.*?</script>', ' ', 'gsi'), '<style\b.*?</style>', ' ', 'gsi'), '<[^>]*>', ' ', 'gs'), '[\s\x{a0}]+', ' ', 'g'), ' '))::INTEGER AS text_chars FROM h""")
def html_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.page_parts(table(spark, sf_dir, "pages"))
    return p.select("page_id", "title", F.size("links").alias("n_links"), F.get("links", F.lit(0)).alias("first_link"), "text_chars")


@query(r"""SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, 'https://host/view/' || page_id AS viewer,
    CASE WHEN length(url) <= 10 THEN '***' ELSE left(url, 6) || '...' || right(url, 4) END AS masked FROM pages""")
def url_parts_and_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", T.query_value(u, "page").alias("page"), T.query_value(u, "ref").alias("ref"), T.viewer_url("https://host", F.concat(F.lit("/view/"), "page_id")).alias("viewer"), T.masked(u).alias("masked"))


@query("""SELECT 'T' || o_orderkey AS id, 'Notice ' || o_orderkey AS title, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS category, 'agency ' || o_custkey AS agency, 'C' || o_custkey AS content_id, 'T' || o_orderkey AS toc_id, 'N' AS correction_yn FROM orders""")
def list_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as list pages, a page for each customer, and parsed."""
    s = lambda c: F.col(c).cast("string")
    call = F.concat(F.lit("fnDetail('T"), s("o_orderkey"), F.lit("','Notice "), s("o_orderkey"), F.lit("','"), F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit("','b','"), s("o_orderpriority"), F.lit("','agency "), s("o_custkey"), F.lit("','l','/v?contentId=C"), s("o_custkey"), F.lit("&amp;tocId=T"), s("o_orderkey"), F.lit("','N','')"))
    row = F.concat(F.lit('<tr><td>1</td><td><a href="#" onclick="'), call, F.lit('">x</a></td><td>a</td><td>l</td><td>d</td></tr>'))
    pages = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("/list/"), s("o_custkey")).alias("url")).agg(F.concat(F.lit('<div id="countArea">9건</div><table id="tableArea"><tbody>'), F.array_join(F.collect_list(row), ""), F.lit("</tbody></table>")).alias("html"))
    return S.list_items(pages).select("id", "title", "date", "category", "agency", "content_id", "toc_id", "correction_yn")


@query("""SELECT o_orderkey::VARCHAR AS id, 'Order ' || o_orderkey AS title, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS category, '/view?tocId=' || o_orderkey || '&x=1' AS viewer_path FROM orders""")
def search_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as search answers, one for each customer, and parsed."""
    d = F.col("o_orderdate")
    hit = F.struct(F.col("o_orderkey").cast("string").alias("stored_toc_seq"), F.concat(F.lit("Order "), "o_orderkey").alias("stored_field_subject"), F.date_format(d, "yyyy").alias("stored_field_year"), F.date_format(d, "M").alias("stored_field_month"), F.date_format(d, "d").alias("stored_field_day"), F.concat(F.lit("/view?tocId="), "o_orderkey", F.lit("&amp;x=1")).alias("stored_field_url"))
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.collect_list(hit).alias("list"))
    group = F.struct(F.col("o_orderstatus").alias("category_name"), F.size("list").cast("string").alias("count"), F.col("list"))
    return S.search_items(groups.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(group).alias("data"))).alias("payload"))).select("id", "title", "date", "category", "viewer_path")


@query("""SELECT o_custkey, o_orderstatus AS category, count(*) AS n FROM orders GROUP BY ALL""")
def search_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of answers' groups; they come as text."""
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).cast("string").alias("count"))
    group = F.struct(F.col("o_orderstatus").alias("category_name"), F.col("count"))
    answers = groups.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(group).alias("data"))).alias("payload"))
    return S.search_groups(answers).select("o_custkey", F.col("category_name").alias("category"), F.col("count").alias("n"))


@query("""SELECT s_suppkey, 'unstored_field_subject:(' || (2000 + s_nationkey) || CASE WHEN s_suppkey % 2 = 0 THEN ' AND ' || s_name ELSE '' END || ') AND keyword_category_order:(@@ORDER_NUM)' AS query FROM supplier""")
def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.query(F.col("s_nationkey") + 2000, F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name"))).alias("query"))


@query("""SELECT c_custkey, true AS ok, 1 AS total, 1 AS page, 10 AS per_page, 'road ' || c_custkey AS canonical, c_nationkey::INTEGER AS main_no, c_custkey % 2 = 1 AS historic, CASE WHEN c_custkey % 3 = 0 THEN 'rnMgtSn' ELSE '' END AS missing FROM customer""")
def address_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as an address service's answers, and parsed."""
    k = F.col("c_custkey")
    record = F.struct(F.concat(F.lit(" road "), k).alias("roadAddr"), F.lit("lot").alias("jibunAddr"), F.lit("1100000000").alias("admCd"), F.when(k % 3 != 0, F.lit("7")).otherwise("").alias("rnMgtSn"), F.lit("0").alias("udrtYn"), F.col("c_nationkey").cast("string").alias("buldMnnm"), F.lit("0").alias("buldSlno"), (k % 2).cast("string").alias("hstryYn"))
    common = F.struct(F.lit("0").alias("errorCode"), F.lit("1").alias("totalCount"))
    payload = F.to_json(F.struct(F.struct(common.alias("common"), F.array(record).alias("juso")).alias("results")))
    a = table(spark, sf_dir, "customer").select("c_custkey", I.address_answer(payload).alias("a"))
    return a.select("c_custkey", "a.ok", "a.total", "a.page", "a.per_page", F.col("a.first.canonical_address").alias("canonical"), F.col("a.first.building_main_no").alias("main_no"), "a.historic", F.array_join(I.coordinate_request(F.col("a.first"))["missing"], ",").alias("missing"))


@query("""WITH e AS (SELECT event_id, event_id % 4 AS k, value FROM events) SELECT event_id, CASE WHEN k = 3 THEN NULL ELSE event_id END AS n FROM e""")
def loose_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object in answers that are plain JSON, fenced, within prose, or none."""
    k, o = F.col("event_id") % 4, F.concat(F.lit('{"text": "x", "n": '), "event_id", F.lit("}"))
    raw = F.when(k == 0, o).when(k == 1, F.concat(F.lit("```json\n"), o, F.lit("\n```"))).when(k == 2, F.concat(F.lit('I think {"a": 1} then '), o, F.lit(" as said {no"))).otherwise("nothing")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(N.json_object(raw), "$.n").cast("bigint").alias("n"))


@query("""SELECT event_id, '[{"k":' || (props->>'$.k') || '}]' AS conditions FROM events""")
def nested_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first list of conditions at any depth."""
    payload = F.concat(F.lit('{"a": [{"conditions": []}, {"b": {"conditions": ['), "props", F.lit("]}}]}"))
    return table(spark, sf_dir, "events").select("event_id", F.replace(N.find_list(payload, "conditions"), F.lit(" "), F.lit("")).alias("conditions"))
