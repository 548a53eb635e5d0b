"""Full-text search by an inverted index: stems with postings and places, written in buckets of terms, and a rank by nearness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmscope.functions.stems import terms
from firmscope.operators import names as N

BUCKETS = 64
# The weight of a place, the distance beyond which places count as apart, and the sum of 1 / i**2.
WEIGHT, FAR, NOTHING, SQUARES = 0.1, 100, 1e-30, 1.64493406685


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(rows: DataFrame, id_col: str, text: Column, folder: str, buckets: int = BUCKETS) -> None:
    """Writes `folder`/postings (term, id, places; a folder for each bucket of terms) and `folder`/terms (term, how many rows have it).

    A term's postings are a row for each id, so a common term is many rows and no large one; its bucket is written by as
    many tasks as have rows of it. Ids must be unique; null texts have no terms.
    """
    found = rows.select(F.col(id_col).alias("id"), F.explode(terms(text)).alias("x"))
    postings = found.groupBy("id", "x.term").agg(F.sort_array(F.collect_list("x.at")).alias("places"))  # of one row
    postings.withColumn("bucket", _bucket(F.col("term"), buckets)).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{folder}/postings")
    schema = f"id {rows.schema[id_col].dataType.simpleString()}, term string, places array<int>, bucket int"
    written = rows.sparkSession.read.schema(schema).parquet(f"{folder}/postings")
    written.groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{folder}/terms")


def postings(spark: SparkSession, folder: str, id_type: str, asked: list[int]) -> DataFrame:
    """The postings in the asked buckets; the others aren't read."""
    return spark.read.schema(f"id {id_type}, term string, places array<int>, bucket int").parquet(f"{folder}/postings").filter(F.col("bucket").isin(asked))


def near(distance: Column) -> Column:
    """How much two places so many words apart count."""
    return F.when(distance > FAR, NOTHING).otherwise(1 / (1.005 + 0.05 * F.exp(distance / 1.5 - 2)))


def rank(places: Column) -> Column:
    """Rank of a row from the places (array of arrays) of the asked terms in it, in order of terms.

    With several terms each two places of different ones add up as chances do, 0.1 times the root of near() each; a single
    term's n-th place adds 0.1 / n**2.
    """
    n = F.size(places)
    pair = lambda a, b: F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: WEIGHT * F.sqrt(near(F.abs(x - y))))))
    pairs = F.flatten(F.flatten(F.transform(places, lambda a, i: F.transform(F.slice(places, i + 2, F.size(places)), lambda b: pair(a, b)))))
    several = 1 - F.aggregate(pairs, F.lit(1.0), lambda left, w: left * (1 - w))
    one = F.aggregate(F.transform(F.get(places, 0), lambda x, i: F.lit(WEIGHT) / ((i + 1) * (i + 1))), F.lit(0.0), lambda s, w: s + w) / SQUARES
    return F.when(n == 1, one).when(n > 1, several)


def search(spark: SparkSession, folder: str, queries: DataFrame, top: int = 20, id_type: str = "bigint", buckets: int = BUCKETS) -> DataFrame:
    """query_id, id, rank, place (from 1) of each query's `top` rows that have all of its terms, the highest rank first, of equal ones the least id.

    queries: query_id (unique), text. Queries without terms, or with one that no row has, find nothing. A query's rows are
    taken from its rarest term; of its other terms only postings of these rows are joined. The driver learns which of the
    buckets are asked for.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct(F.transform(terms(F.col("text")), lambda x: x["term"]))).alias("term"))
    asked = N.kept(asked.join(spark.read.schema("term string, df bigint").parquet(f"{folder}/terms"), "term", "left"))
    wanted = asked.groupBy("query_id").agg(F.count("*").alias("n"), F.count("df").alias("known"), F.min(F.struct("df", "term")).alias("m"), F.sum("df").alias("total")).filter("n = known")
    wanted = N.kept(wanted.select("query_id", F.col("n"), F.col("m.term").alias("term"), F.col("m.df").alias("df")))
    held = [r["b"] for r in asked.join(wanted.select("query_id"), "query_id", "left_semi").select(_bucket(F.col("term"), buckets).alias("b")).distinct().collect()]  # as many as there are buckets
    index = postings(spark, folder, id_type, held).drop("bucket")
    total = wanted.select("term", "df").distinct().agg(F.sum("df")).first()[0]
    first = N.dealt(wanted.select("query_id", "n", "term"), index.join(wanted.select("term").distinct(), "term", "left_semi"), ["term"], total)
    others = asked.select("query_id", F.col("term").alias("other")).join(first.select("query_id", "id", "term"), "query_id").filter("other <> term")
    more = others.select("query_id", "id", F.col("other").alias("term")).join(index, ["term", "id"]).select("query_id", "id", "term", "places")
    hits = first.select("query_id", "id", "term", "places").unionByName(more).groupBy("query_id", "id").agg(F.sort_array(F.collect_list(F.struct("term", "places"))).alias("x"))  # a query's terms
    full = hits.join(wanted.select("query_id", "n"), "query_id").filter(F.size("x") == F.col("n"))
    ranked = full.select("query_id", "id", F.round(rank(F.col("x.places")), 9).alias("rank"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rank"), "id"))
    return ranked.withColumn("place", place.cast("long")).filter(F.col("place") <= top)
