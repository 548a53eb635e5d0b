"""Watchlists, seeds, overrides and feeds: readers of their files, and their rows as entities of one schema.

Entities: list_id, entity_id, entity_type, primary_name, name_variants, name_normalized, program, sanctions_list,
nationality, added_date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.functions import extract as E
from firmscope.functions import text as X
from firmscope.sources import readers

#: Columns of the headerless list.
OFAC_COLUMNS = ["ent_num", "sdn_name", "sdn_type", "program", "title", "call_sign", "vess_type", "tonnage", "grt", "vess_flag", "vess_owner", "remarks"]
_text, _texts = T.StringType(), T.ArrayType(T.StringType())
_alias = T.ArrayType(T.StructType([T.StructField("ALIAS_NAME", _text)]))
_value = T.ArrayType(T.StructType([T.StructField("VALUE", _texts)]))
_common = [T.StructField(n, _text) for n in ("DATAID", "REFERENCE_NUMBER", "FIRST_NAME", "NAME_ORIGINAL_SCRIPT", "UN_LIST_TYPE", "LISTED_ON")]
UN_PERSON = T.StructType([*_common, *(T.StructField(n, _text) for n in ("SECOND_NAME", "THIRD_NAME", "FOURTH_NAME")), T.StructField("INDIVIDUAL_ALIAS", _alias), T.StructField("NATIONALITY", _value), T.StructField("LIST_TYPE", _value)])
UN_BODY = T.StructType([*_common, T.StructField("ENTITY_ALIAS", _alias)])


def ofac(spark: SparkSession, path: str) -> DataFrame:
    return readers.headerless_csv(spark, path, OFAC_COLUMNS)


def ofac_entities(records: DataFrame, list_id: int, as_of: Column) -> DataFrame:
    """Entities of the headerless list, which has no dates of its own: as_of is when they were added."""
    name = F.trim("sdn_name")
    return records.select(
        F.lit(list_id).alias("list_id"), F.col("ent_num").alias("entity_id"), E.entity_type(F.coalesce("sdn_type", F.lit(""))).alias("entity_type"), name.alias("primary_name"),
        E.quoted_aliases(F.col("remarks")).alias("name_variants"), X.name_delete(name).alias("name_normalized"), F.coalesce(F.nullif("program", F.lit("")), F.lit("UNKNOWN")).alias("program"),
        F.lit("SDN").alias("sanctions_list"), E.nationality(F.coalesce("remarks", F.lit(""))).alias("nationality"), F.to_date(as_of).alias("added_date"),
    )


def un_people(spark: SparkSession, path: str) -> DataFrame:
    return readers.xml_entities(spark, path, "INDIVIDUAL", UN_PERSON)


def un_bodies(spark: SparkSession, path: str) -> DataFrame:
    return readers.xml_entities(spark, path, "ENTITY", UN_BODY)


def _un(records: DataFrame, list_id: int, kind: str, name: Column, aliases: Column, nationality: Column, program: Column, as_of: Column) -> DataFrame:
    given = F.transform(F.coalesce(aliases, F.array().cast("array<struct<ALIAS_NAME:string>>")), lambda a: a["ALIAS_NAME"])
    variants = F.array_distinct(F.filter(F.concat(given, F.array("NAME_ORIGINAL_SCRIPT")), lambda x: F.coalesce(x, F.lit("")) != ""))
    return records.select(
        F.lit(list_id).alias("list_id"), F.coalesce(F.nullif("REFERENCE_NUMBER", F.lit("")), "DATAID").alias("entity_id"), F.lit(kind).alias("entity_type"), name.alias("primary_name"),
        variants.alias("name_variants"), X.name_delete(name).alias("name_normalized"), F.coalesce(F.nullif(program, F.lit("")), F.lit("UNKNOWN")).alias("program"),
        F.lit("UN_CONSOLIDATED").alias("sanctions_list"), nationality.alias("nationality"), F.coalesce(F.to_date(F.try_to_timestamp("LISTED_ON")), F.to_date(as_of)).alias("added_date"),
    )


def un_entities(people: DataFrame, bodies: DataFrame, list_id: int, as_of: Column) -> DataFrame:
    """Entities of both groups, one under the other. A date that can't be read is as_of."""
    values = lambda c: F.coalesce(F.flatten(F.transform(F.col(c), lambda n: n["VALUE"])), F.array().cast("array<string>"))
    name = E.full_name(*(F.col(c) for c in ("FIRST_NAME", "SECOND_NAME", "THIRD_NAME", "FOURTH_NAME")))
    program = F.coalesce(F.nullif("UN_LIST_TYPE", F.lit("")), F.get(values("LIST_TYPE"), 0))
    nations = F.filter(F.flatten(F.transform(F.coalesce("NATIONALITY", F.array().cast("array<struct<VALUE:array<string>>>")), lambda n: F.slice(n["VALUE"], 1, 1))), lambda x: F.coalesce(x, F.lit("")) != "")
    one = _un(people, list_id, "individual", name, F.col("INDIVIDUAL_ALIAS"), nations, program, as_of)
    return one.unionByName(_un(bodies, list_id, "entity", E.full_name(F.col("FIRST_NAME")), F.col("ENTITY_ALIAS"), F.array().cast("array<string>"), F.col("UN_LIST_TYPE"), as_of))


def csv_names(spark: SparkSession, path: str) -> DataFrame:
    """name: the second field of each line but the first of a file, the only one where there is no second; blank ones are left out."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).filter("pos > 0")
    parts = F.split("line", ",")
    name = F.regexp_replace(F.trim(F.when(F.size(parts) > 1, F.get(parts, 1)).otherwise(F.get(parts, 0))), '^"+|"+$', "")
    return lines.select("pos", name.alias("name")).filter("name <> ''")


def xml_names(spark: SparkSession, path: str) -> DataFrame:
    """name: the text of every element whose tag ends in name or fullname, whatever its case and namespace."""
    found = F.regexp_extract_all("value", F.lit(r"(?i)<(?:[\w\-]+:)?[\w\-]*name(?:\s[^>]*)?>([^<]+)<"), F.lit(1))
    d = spark.read.text(path, wholetext=True).select(F.posexplode(found).alias("pos", "name"))
    decoded = F.col("name")
    for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        decoded = F.replace(decoded, F.lit(mark), F.lit(sign))
    return d.select("pos", F.trim(decoded).alias("name")).filter("name <> ''")


def rss_items(spark: SparkSession, path: str, as_of: Column, most: int | None = None) -> DataFrame:
    """title, link, date, summary of the items of RSS files that have a title; an unreadable date is as_of. `most`: the first ones of each file."""
    schema = T.StructType([T.StructField(n, _text) for n in ("title", "link", "pubDate", "description")])
    d = readers.xml_entities(spark, path, "item", schema)
    rows = d.select(F.trim("title").alias("title"), F.trim(F.coalesce("link", F.lit(""))).alias("link"), F.coalesce(E.rss_date(F.trim("pubDate")), as_of.cast("timestamp")).alias("date"), F.trim(F.coalesce("description", F.lit(""))).alias("summary"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    if most is not None:
        from pyspark.sql import Window

        rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("file").orderBy("at"))).filter(F.col("k") <= most).drop("k")
    return rows.drop("file", "at").filter("title <> ''")


def regulatory_events(items: DataFrame, source: str) -> DataFrame:
    """items with event_id, event_type, severity and impact, all from the title."""
    from firmscope.functions import rules as L

    key = F.concat(F.lit(f"{source.upper()}-"), F.substring(F.sha2(F.concat_ws(":", F.lit(source), "title", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")), 256), 1, 12))
    kind = E.severity(F.col("title"))
    return items.withColumns({"event_id": key, "event_type": E.event_type(F.col("title")), "severity": kind, "impact": L.severity_impact(kind)})


def seed(spark: SparkSession, path: str) -> DataFrame:
    """brand_name, website_root, status (watchlist where none is given) of a JSON array of firms with a brand and a website."""
    schema = T.StructType([T.StructField(n, _text) for n in ("brand_name", "website_root", "model_type", "status")])
    d = readers.json_array(spark, path, schema).filter(~(F.coalesce(F.trim("brand_name"), F.lit("")) == "") & ~(F.coalesce(F.trim("website_root"), F.lit("")) == ""))
    return d.withColumn("status", F.coalesce(F.nullif("status", F.lit("")), F.lit("watchlist")))


def overrides(spark: SparkSession, manual: str, auto: str | None = None) -> DataFrame:
    """firm_id (lower case) and fields (map of text) of JSON objects by firm; keys with a leading _ are notes. Manual fields win over automatic ones, firm by firm."""

    def one(path: str) -> DataFrame:
        whole = F.from_json("value", "map<string,string>")
        rows = spark.read.text(path, wholetext=True).select(F.explode(whole).alias("k", "v")).filter(~F.col("k").startswith("_"))
        return rows.select(F.lower("k").alias("firm_id"), F.from_json("v", "map<string,string>").alias("fields")).filter("fields is not null")

    m = one(manual)
    if auto is None:
        return m
    a = one(auto).withColumnRenamed("fields", "auto")
    keep = F.map_filter("auto", lambda k, v: ~F.coalesce(F.map_contains_key("fields", k), F.lit(False)))
    return m.join(a, "firm_id", "full_outer").select("firm_id", F.map_concat(F.coalesce(keep, F.create_map().cast("map<string,string>")), F.coalesce("fields", F.create_map().cast("map<string,string>"))).alias("fields"))


def newest_firm_ids(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Distinct firm_id of the newest CSV file (with header) of a folder, by its time of change."""
    d = spark.read.csv(folder, header=True).select("firm_id", F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    last = d.agg(F.max(F.struct("at", "file")).alias("m")).select(F.col("m.file").alias("file"))
    ids = d.join(F.broadcast(last), "file").select("firm_id").filter("firm_id is not null").distinct()
    return ids if limit is None else ids.orderBy("firm_id").limit(limit)


def latest_snapshot(spark: SparkSession, pointer: str) -> str | None:
    """What a pointer file names: its object, snapshot_key or path, whichever is first; None if it has none."""
    row = spark.read.json(pointer, multiLine=True)
    names = [c for c in ("object", "snapshot_key", "path") if c in row.columns]
    return row.select(F.coalesce(*names).alias("k")).first()["k"] if names else None


def object_parts(path: Column) -> Column:
    """struct(bucket, object) of bucket/object, with or without s3:// in front."""
    bare = F.regexp_replace(path, "^s3a?://", "")
    return F.struct(F.split_part(bare, F.lit("/"), F.lit(1)).alias("bucket"), F.regexp_replace(bare, "^[^/]*/?", "").alias("object"))


def needs_update(updated: Column, as_of: Column, hours: int = 24) -> Column:
    """Never loaded, or `hours` or more ago."""
    return updated.isNull() | (as_of.cast("timestamp") >= updated.cast("timestamp") + F.make_dt_interval(hours=F.lit(hours)))
