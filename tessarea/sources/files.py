"""Files beyond plain Parquet. All reading and parsing is Spark's; the driver sees schemas and small reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessarea.operators import expect


def read_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None, separator: str = ",", encodings: Sequence[str] = ("UTF-8", "ISO-8859-1")) -> DataFrame:
    """A text table with a header, all columns as strings, so that leading zeros stay; quotes within quotes are doubled. The first encoding in which no text is malformed is taken."""
    for encoding in encodings:
        df = spark.read.csv(path, header=True, sep=separator, encoding=encoding, inferSchema=False, escape='"')
        if encoding == encodings[-1] or not df.filter(F.concat_ws("", *df.columns).contains("�")).limit(1).count():
            return df.select(*columns) if columns else df
    raise ValueError("no encoding is named")


def hive_scan(spark: SparkSession, path: str, where: str, columns: Sequence[str]) -> DataFrame:
    """A partitioned Parquet folder: partitions are pruned and filters pushed by ``where``; with the file's path as ``filename``."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("filename")).filter(where).select(*columns, "filename")


def sniffed_table(spark: SparkSession, path: str, words: Sequence[str], least: int, separator: str = ",") -> DataFrame:
    """Rows under the first line that holds ``least`` or more of the words, by that line's names. One file; its lines' order is Spark's for a file read in one split."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line")).filter(F.trim("line") != "")
    hits = sum((F.lower("line").contains(w.lower()).cast("int") for w in words), F.lit(0))
    head = lines.filter(hits >= least).orderBy("at").limit(1).collect()
    if not head:
        raise expect.ExpectationError(f"{path} has no header with {least} of {list(words)}")
    names = [x.strip() for x in head[0]["line"].split(separator)]
    cells = F.split("line", separator if separator.isalnum() else f"\\{separator}")
    return lines.filter(F.col("at") > head[0]["at"]).select("at", *[F.trim(F.get(cells, i)).alias(n) for i, n in enumerate(names)]).orderBy("at").drop("at")


def read_report(spark: SparkSession, path: str, label: str = "offense", column: str = "year", value: str = "count") -> DataFrame:
    """A report of title lines, a header whose cells but the first are years, and a matrix: as rows (label, year, value). Thousands commas in quotes are allowed; what is no number is NULL."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    cells = F.split("line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)')  # commas outside quotes
    rows = lines.select("at", F.transform(cells, lambda x: F.trim(F.regexp_replace(F.trim(x), '^"|"$', ""))).alias("cells"))
    years = F.filter(F.slice("cells", 2, 1_000), lambda x: x.rlike(r"^(19|20)\d\d$"))
    head = rows.filter((F.size("cells") > 1) & (F.size(years) == F.size("cells") - 1)).orderBy("at").limit(1).select(F.col("at").alias("head_at"), F.slice("cells", 2, 1_000).alias("years"))
    body = rows.crossJoin(F.broadcast(head)).filter((F.col("at") > F.col("head_at")) & (F.get("cells", 0) != "") & (F.size("cells") > 1))
    long = body.select(F.get("cells", 0).alias(label), F.posexplode("years").alias("i", column), "cells")
    return long.select(label, F.col(column).cast("int").alias(column), F.regexp_replace(F.get("cells", F.col("i") + 1), ",", "").try_cast("double").alias(value))


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A GeoJSON feature collection: the properties (a DDL schema), ``rings``, all rings of a polygon's or multipolygon's parts, holes among them, and
    ``ring``, a polygon's outer one; both are arrays of (x, y), NULL for other shapes."""
    shape = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    return _rings(raw).select("f.properties.*", "ring", "rings")


def read_feature_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """The same with a feature a line (newline-delimited GeoJSON), which Spark splits: for files beyond what one row may hold."""
    raw = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json(F.regexp_replace("value", "\u001e", ""), f"properties struct<{properties}>, geometry struct<type: string, coordinates: string>").alias("f"))
    return _rings(raw).select("f.properties.*", "ring", "rings")


def _rings(raw: DataFrame) -> DataFrame:
    point = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    places = lambda rings: F.transform(rings, lambda ring: F.transform(ring, point))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    kind = F.col("f.geometry.type")
    rings = F.when(kind == "Polygon", places(one)).when(kind == "MultiPolygon", places(F.flatten(many)))
    return raw.withColumn("rings", rings).withColumn("ring", F.when(kind == "Polygon", F.get("rings", 0)))


def require_coverage(df: DataFrame, by: str, wanted: Sequence, least: int) -> list:
    """Values of ``by`` (among ``wanted``) with ``least`` rows; none at all is an error."""
    n = {r[by]: r["count"] for r in df.filter(F.col(by).isin(*wanted)).groupBy(by).count().collect()}
    found = [w for w in wanted if n.get(w, 0) >= least]
    if not found:
        raise expect.ExpectationError(f"no {by} has {least} rows: {n}")
    return found


def input_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, bytes and SHA-256 of each file, which tasks read. A missing file is an error."""
    rows = spark.read.format("binaryFile").load(list(paths))
    return rows.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _time(spark: SparkSession, path: str) -> int | None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getFileStatus(where).getModificationTime() if store.exists(where) else None


def is_fresh(spark: SparkSession, built: str, needs: Sequence[str]) -> bool:
    """Whether what was built is there and no older than anything it needs; a need that is missing is an error."""
    times = [_time(spark, n) for n in needs]
    if None in times:
        raise FileNotFoundError(needs[times.index(None)])
    own = _time(spark, built)
    return own is not None and own >= max(times, default=0)


def markdown_table(df: DataFrame, most: int = 1_000) -> str:
    """A small report's rows as a Markdown table; more than ``most`` rows are an error, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)])


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """CSV with a header, or JSON lines, as Spark writes them."""
    if kind not in ("csv", "json"):
        raise ValueError(f"unknown kind {kind}")
    (df.write.csv(path, header=True) if kind == "csv" else df.write.json(path))
