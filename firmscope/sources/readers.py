"""Readers of the formats that evidence and watchlists come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int = 16) -> DataFrame:
    """A table of a database, read in ranges of a numeric column."""
    return spark.read.jdbc(url, table, column, low, high, parts)


def headerless_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Strings, outer blanks trimmed; missing columns of short rows are null, further ones are dropped."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)


def json_records(spark: SparkSession, path: str, field: str = "records", schema: T.StructType | None = None) -> DataFrame:
    """Rows of an array field of JSON documents."""
    d = spark.read.schema(schema).json(path, multiLine=True) if schema else spark.read.json(path, multiLine=True)
    return d.select(F.explode(field).alias("r")).select("r.*")


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def xml_entities(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def raw_objects(spark: SparkSession, path: str) -> DataFrame:
    """path, length and content of files; is_pdf by their first bytes."""
    d = spark.read.format("binaryFile").load(path)
    return d.withColumn("is_pdf", F.substring("content", 1, 4) == F.lit(bytearray(b"%PDF")))


def sitemap_urls(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


def robots_sitemaps(text: Column, most: int | None = None) -> Column:
    """Addresses after "sitemap:", whole and in order; all of them, or the first `most`."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.lower(F.trim(x)).startswith("sitemap:"))
    found = F.transform(lines, lambda x: F.trim(F.substr(F.trim(x), F.lit(9))))
    return found if most is None else F.slice(found, 1, most)


def with_columns_or_null(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The named columns; those that df lacks are null of the given type."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()))
