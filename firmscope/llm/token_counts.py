"""Token counts by an exact length histogram with suffix sums."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed, map_texts
from firmscope.llm.encode import encoder


def token_lengths(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", extra: int = 0) -> DataFrame:
    """id_col and `n_tokens` (long) of every whole text, plus `extra` for ids such as an end mark.

    Null and empty texts have no tokens. Repeated rows and null ids are rows like any other. Other columns are not read.
    """

    def make():
        encode = encoder(vocab)
        return lambda texts: [pa.array([len(b) // 4 + extra for b in encode(texts)], pa.int64())]

    return map_texts(docs, [id_col], text_col, make, "n_tokens long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens", block: int = 128) -> DataFrame:
    """One row for each length that occurs, with suffix sums over the lengths from it on.

    Columns: length, n_docs, n_tokens, docs_ge, tokens_ge (documents of this length or more, and their tokens), docs_all,
    tokens_all, truncated_total (tokens left if every document is cut to `length`), share_le (part of the documents
    that have this length or less). An empty table gives no rows; null lengths count as 0.

    The suffix sums take two levels, blocks of `block` lengths and lengths in a block, so no task gets all lengths. The counts are kept in the checkpoint folder, as both levels read them.
    """
    h = lengths.groupBy(F.coalesce(F.col(length_col), F.lit(0)).cast("long").alias("length")).agg(F.count("*").alias("n_docs"))
    h = checkpointed(h).select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / block).alias("__b"))
    blocks = h.groupBy("__b").agg(F.sum("n_docs").alias("__d"), F.sum("n_tokens").alias("__t"))
    down, every = Window.orderBy(F.col("__b").desc()), Window.partitionBy()
    blocks = blocks.select(
        "__b",
        (F.sum("__d").over(down) - F.col("__d")).alias("__da"),
        (F.sum("__t").over(down) - F.col("__t")).alias("__ta"),
        F.sum("__d").over(every).alias("docs_all"),
        F.sum("__t").over(every).alias("tokens_all"),
    )
    inside = Window.partitionBy("__b").orderBy(F.col("length").desc())
    return (
        h.withColumns({"__di": F.sum("n_docs").over(inside), "__ti": F.sum("n_tokens").over(inside)})
        .join(blocks, "__b")
        .select("length", "n_docs", "n_tokens", (F.col("__di") + F.col("__da")).alias("docs_ge"), (F.col("__ti") + F.col("__ta")).alias("tokens_ge"), "docs_all", "tokens_all")
        .withColumn("truncated_total", F.col("tokens_all") - F.col("tokens_ge") + F.col("length") * F.col("docs_ge"))
        .withColumn("share_le", (F.col("docs_all") - F.col("docs_ge") + F.col("n_docs")) / F.col("docs_all"))
    )


def context_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: total tokens when longer documents are cut to it, and how many are cut."""
    spark = histogram.sparkSession
    first = [F.min_by(F.struct("docs_ge", "tokens_ge"), F.when(F.col("length") > n, F.col("length"))).alias(f"__{i}") for i, n in enumerate(limits)]
    one = histogram.agg(F.max("tokens_all").alias("__all"), *first)
    if not limits:
        return spark.createDataFrame([], "context_limit long, total_tokens long, docs_cut long")
    rows = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(n).cast("long").alias("context_limit"),
                    (F.coalesce("__all", F.lit(0)) - F.coalesce(f"__{i}.tokens_ge", F.lit(0)) + n * F.coalesce(f"__{i}.docs_ge", F.lit(0))).alias("total_tokens"),
                    F.coalesce(f"__{i}.docs_ge", F.lit(0)).alias("docs_cut"),
                )
                for i, n in enumerate(limits)
            )
        )
    )
    return one.select(rows.alias("r")).select("r.*")


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share: the least length that at least this part of the documents does not exceed."""
    got = histogram.agg(*(F.min(F.when(F.col("share_le") >= q, F.col("length"))).alias(f"__{i}") for i, q in enumerate(shares)))
    return got.select(F.explode(F.array(*(F.struct(F.lit(float(q)).alias("share"), F.col(f"__{i}").alias("length")) for i, q in enumerate(shares)))).alias("r")).select("r.*")
