"""History of firms' records: captured snapshots, versions with validity, and changes between loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.functions import rules as L


def captured(firms: DataFrame, snapshot_id: str, snapshot_hash: str) -> DataFrame:
    """Rows to keep of a snapshot's firms: firm_id, firm_name, score, score_normalized, confidence, status, metrics, snapshot_id, snapshot_hash.

    firm_id or id, firm_name or name, and score_0_100, score or integrity_score, whichever is there and isn't blank or 0
    first (the last of each also if it is 0); rows without any of the three are left out. Scores above 1 are taken as percent. Columns that firms lacks are null.
    """
    has = lambda c, kind="string": F.col(c).cast(kind) if c in firms.columns else F.lit(None).cast(kind)
    blank = {"string": "", "double": 0.0}
    first = lambda kind, *names: F.coalesce(*(F.nullif(has(n, kind), F.lit(blank[kind])) for n in names[:-1]), has(names[-1], kind))
    score = first("double", "score_0_100", "score", "integrity_score")
    metrics = F.struct(has("na_rate", "double").alias("na_rate"), *(has(c).alias(c) for c in ("jurisdiction_tier", "model_type", "payout_frequency")))
    d = firms.select(first("string", "firm_id", "id").alias("firm_id"), first("string", "firm_name", "name").alias("firm_name"), score.alias("score"), F.coalesce(has("confidence"), F.lit("medium")).alias("confidence"), F.coalesce(has("status"), F.lit("candidate")).alias("status"), metrics.alias("metrics"))
    d = d.filter((F.coalesce("firm_id", F.lit("")) != "") & (F.coalesce("firm_name", F.lit("")) != "") & F.col("score").isNotNull())
    return d.select("firm_id", "firm_name", "score", L.as_share(F.col("score")).alias("score_normalized"), "confidence", "status", "metrics", F.lit(snapshot_id).alias("snapshot_id"), F.lit(snapshot_hash).alias("snapshot_hash"))


def recorded(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """old with new rows in place of those of the same keys, and one row with how many were inserted and updated."""
    held = old.select(*keys).distinct().withColumn("__held", F.lit(True))
    marked = new.join(held, keys, "left")
    counts = marked.agg(F.count(F.when(F.col("__held").isNull(), 1)).alias("inserted"), F.count("__held").alias("updated"))
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new), counts


def _hash(fields: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def versions(history: DataFrame | None, load: DataFrame, key: str, fields: list[str], at: Column) -> DataFrame:
    """history with a load merged in: key, fields, hash, valid_from, valid_to (null while valid).

    A key's open version is closed at `at` and a new one opened where any field has changed; it is closed where the load
    lacks the key, opened where it is new or comes back, and left as it is otherwise, so that the same load twice changes
    nothing. Fields are compared by a hash, null being a value of its own. Keys must be unique in a load; a load with an
    `at` before that of the last one isn't allowed. Only open versions take part in the join; closed ones pass.
    """
    new = load.select(key, *fields).withColumn("hash", _hash(fields))
    if history is None:
        return new.withColumns({"valid_from": at, "valid_to": F.lit(None).cast("long")}).select(key, *fields, "hash", "valid_from", "valid_to")
    of = lambda d, mark: d.select(F.col(key).alias(f"{mark}_key"), F.struct(*fields, "hash", *(["valid_from"] if mark == "o" else [])).alias(mark))
    open_ = history.filter("valid_to IS NULL")
    both = of(open_, "o").join(of(new, "n"), F.col("o_key").eqNullSafe(F.col("n_key")), "full_outer")
    o, n = F.col("o"), F.col("n")
    row = lambda s, k, since, until: F.struct(F.col(k).alias(key), *(s[f].alias(f) for f in fields), s["hash"].alias("hash"), since.cast("long").alias("valid_from"), until.cast("long").alias("valid_to"))
    none, same = F.lit(None), o.isNotNull() & n.isNotNull() & (o["hash"] == n["hash"])
    kept = F.when(o.isNotNull(), row(o, "o_key", o["valid_from"], F.when(same, none).otherwise(at)))
    opened = F.when(n.isNotNull() & ~same, row(n, "n_key", at, none))
    merged = both.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*")
    return history.filter("valid_to IS NOT NULL").unionByName(merged)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The versions that are valid at a time."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
