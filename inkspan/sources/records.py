"""JSON items, keyed stores, JSONL manifests and lists of files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkspan.functions.text import nz
from inkspan.operators.items import best_of


def items(spark: SparkSession, folder: str) -> DataFrame:
    """(path, raw, item, json_error) of every JSON file below a folder; a file that is no object is an error row, never a failure."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    parsed = raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"), F.try_parse_json("value").alias("item"))
    ok = F.coalesce(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")), F.lit(False))
    return parsed.select("path", "raw", F.when(ok, F.col("item")).alias("item"), (~ok).alias("json_error"))


def typed_items(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The items of a folder as columns of a schema, with their path, raw text and json_error."""
    return items(spark, folder).withColumn("__s", F.when(~F.col("json_error"), F.from_json("raw", schema))).select("path", "raw", "json_error", "__s.*")


def store(spark: SparkSession, aggregate: str | None, folder: str | None) -> DataFrame:
    """(id, raw) of a keyed store: an aggregate file of id to item, overlaid by single files, the later path first; empty ids are left out."""
    parts = []
    if aggregate:
        whole = spark.read.text(aggregate, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("id", "raw"))
        parts.append(whole.withColumns({"prio": F.lit(0), "path": F.lit("")}))
    if folder:
        single = items(spark, folder).where("not json_error")
        parts.append(single.select(F.get_json_object("raw", "$.id").alias("id"), "raw", F.lit(1).alias("prio"), "path"))
    all_ = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return best_of(all_.where(nz(F.col("id")).isNotNull()), "id", F.desc("prio"), F.desc("path")).select("id", "raw")


def lookup(table: DataFrame, year: str, date_key: str, item_id: str) -> DataFrame:
    """One item of a table partitioned by year and date_key: only its partition is read."""
    return table.where((F.col("year") == year) & (F.col("date_key") == date_key) & (F.col("id") == item_id))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_number, value) of text files' lines, from 0 in each. Files are read in splits; a split's lines are numbered from the number of lines of its file's earlier splits."""
    raw = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__row"), F.regexp_replace("value", "\r$", "").alias("value"))
    splits = raw.groupBy("path", "__at").agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("__first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("path", "__at", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__offset"))
    return raw.join(offsets, ["path", "__at"]).select("path", (F.col("__row") + F.col("__offset")).cast("int").alias("line_number"), "value")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSONL manifest: blank lines are left out, malformed ones have manifest_error; line_number from 0."""
    lines = _lines(spark, path).where(F.trim("value") != "")
    ok = F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("value")), F.lit("OBJECT")), F.lit(False))
    parsed = lines.withColumn("__r", F.when(ok, F.from_json("value", schema)))
    return parsed.select("line_number", F.when(~ok, F.concat(F.lit("malformed line: "), F.left("value", F.lit(200)))).alias("manifest_error"), "__r.*")


def strict_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL in which every line must be right; a malformed one fails the query. _line_number from 1."""
    lines = _lines(spark, path).where(F.trim("value") != "")
    return lines.select((F.col("line_number") + 1).alias("_line_number"), F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("_line_number", "r.*")


def tolerant_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL whose malformed lines are dropped; splits as Spark likes."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def listed(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """(path) of a list of files, without blank lines and comments, below a root."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~F.startswith(line, F.lit("#"))).select(F.when(F.startswith(line, F.lit("/")), line).otherwise(F.concat(F.lit(root.rstrip("/") + "/" if root else ""), line)).alias("path"))


def objects(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(key, size) of every object below a folder or bucket: contents are not read."""
    base = folder.rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    plain = F.regexp_replace("path", "^file:/*", "/")
    at = F.regexp_replace(F.lit(base), "^file:/*", "/")
    return found.select(F.concat(F.lit(prefix), F.substring(plain, F.length(at) + 1, F.length(plain))).alias("key"), F.col("length").alias("size"))


def download_plan(remote: DataFrame, local: DataFrame, overwrite: bool = False) -> DataFrame:
    """Objects to fetch: all, or those that aren't here with their size."""
    return remote if overwrite else remote.join(local, ["key", "size"], "left_anti")


class Config:
    """Settings by dotted names: of nested dictionaries, or of a YAML file if a reader is installed."""

    def __init__(self, values: dict) -> None:
        self.values = values

    @classmethod
    def read(cls, path: str) -> "Config":
        text = Path(path).read_text(encoding="utf-8")
        try:
            import yaml
        except ModuleNotFoundError:
            return cls(_indented(text.splitlines()))
        return cls(yaml.safe_load(text) or {})

    def get(self, name: str, default=None):
        at = self.values
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at


def _indented(lines: list[str]) -> dict:
    """Nested scalars and lists by indentation: what a plain settings file holds."""
    root: dict = {}
    stack: list[tuple[int, dict | list]] = [(-1, root)]
    pending: tuple[dict, str] | None = None
    for raw in lines:
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        depth, text = len(line) - len(line.lstrip()), line.strip()
        if pending and depth > stack[-1][0] or pending and text.startswith("- "):
            holder, key = pending
            holder[key] = [] if text.startswith("- ") else {}
            stack.append((depth - 1 if text.startswith("- ") else depth - 1, holder[key]))
        pending = None
        while len(stack) > 1 and depth <= stack[-1][0]:
            stack.pop()
        top = stack[-1][1]
        if text.startswith("- "):
            top.append(_scalar(text[2:]))
        else:
            key, _, value = text.partition(":")
            if value.strip():
                top[key.strip()] = _scalar(value.strip())
            else:
                top[key.strip()] = None
                pending = (top, key.strip())
    return root


def _scalar(text: str):
    if text[:1] in "'\"" and text[-1:] == text[:1]:
        return text[1:-1]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "false": False, "null": None, "~": None}.get(text.lower(), text)
