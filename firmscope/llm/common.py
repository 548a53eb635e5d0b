"""What the operators of this subpackage share: checkpoints, the shared folder, and batches of texts as Arrow."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's spark.checkpoint.dir. Where that is unset (tests in local mode) a temporary folder is made;
    on a cluster a local folder would be of no use to the executors, so an unset one is an error there.
    """
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="firmscope-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared checkpoint folder: later steps read it there even if an executor is lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new URI under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def lower_az(text):
    """Only A-Z are lower-cased. lower() does that for plain ASCII and is quicker than translate()."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def map_texts(
    df: DataFrame,
    keep: list[str],
    text_col: str,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    fields: str,
    rows: int = 1000,
) -> DataFrame:
    """The columns keep, unchanged, and beside them what make()(texts) returns for each batch of whole texts.

    make runs once in each task; fields names the columns that it adds, as in a DDL string.
    """
    added = T._parse_datatype_string(fields)
    schema = T.StructType([df.schema[k] for k in keep] + added.fields)
    names = schema.names

    at_text = keep.index(text_col) if text_col in keep else len(keep)  # a text that is kept goes to Python once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + work(b.column(at_text).to_pylist()), names=names)

    return df.select(*keep, *([] if text_col in keep else [F.col(text_col).alias("__text")])).mapInArrow(run, schema)


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1 and so on, so that none has the name of a working column."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def join_by_count(rows: DataFrame, one: DataFrame, key: list[str], count: str, parts: int = 1_000, floor: int = 0) -> DataFrame:
    """rows joined with `one`, which has one row a key and in `count` how many of rows have that key.

    Keys with more than one in `parts` of all rows are fewer than `parts`, whatever the tables hold: that bound allows
    to broadcast them, so their rows stay where they are. The others are joined by a shuffle; both sides are then read
    twice. Without such a key, or where none has more than `floor` rows, it is a plain join.
    """
    size = one.agg(F.sum(count).alias("n"), F.max(count).alias("most")).first()
    if not size["n"] or size["most"] * parts <= size["n"] or size["most"] <= floor:
        return rows.join(one, key)
    common = (F.col(count) * parts > size["n"]) & (F.col(count) > floor)
    hot, cold = one.filter(common), one.filter(~common)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cold, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def bucketed_rank(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with `rank` (long, from 0): the place of each row within its key, without all rows of a key in one task.

    The n rows of a key are dealt to about sqrt(n) buckets by a hash of the order columns, which must tell rows apart;
    the place is the sum of the buckets before plus the place in the bucket. So neither a bucket nor the counts of a
    key's buckets are many rows. The keys must be few, by their kind: their counts are broadcast.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("__n"))
    dealt = df.join(F.broadcast(sizes), key).withColumn("__b", F.pmod(F.xxhash64(*order), F.ceil(F.sqrt(F.col("__n"))).cast("long"))).drop("__n")
    counts = dealt.groupBy(key, "__b").agg(F.count("*").alias("__n"))
    before = counts.select(key, "__b", (F.sum("__n").over(Window.partitionBy(key).orderBy("__b")) - F.col("__n")).alias("__before"))
    local = dealt.withColumn("__r", F.row_number().over(Window.partitionBy(key, "__b").orderBy(*order)) - 1)
    return local.join(before, [key, "__b"]).withColumn("rank", F.col("__before") + F.col("__r")).drop("__b", "__r", "__before")
