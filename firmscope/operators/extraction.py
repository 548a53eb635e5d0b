"""Fields from collected evidence: an ordered fold that stops early, merging of parts, and winners by source with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import payload as J
from firmscope.functions import text as X
from firmscope.operators import links as K
from firmscope.operators.tables import kept

# Kinds of evidence, words and the least length of a text.
RULE_KEYS, PRICING_KEYS, BOTH_KEYS = ["rules_html", "rules_pdf"], ["pricing_html", "pricing_pdf"], ["xhr_json", "external_html", "external_pdf"]
PRICING_PATHS = ("pricing", "fees", "challenge", "evaluation", "profit-split")
RULE_PATHS = ("rules", "drawdown", "payout", "withdraw", "terms")
RULE_BLOCKS = ["rules", "payout", "withdraw", "drawdown", "loss", "consistency", "scaling", "trading days", "terms"]
PRICING_BLOCKS = ["pricing", "fees", "challenge", "evaluation", "account size", "profit split", "refund"]
SHORTEST = 400


def kind(url: Column, key: Column) -> Column:
    """rules or pricing, by words in the address, else by the evidence's key."""
    by_url = E.first_word(F.lower(F.coalesce(url, F.lit(""))), [(PRICING_PATHS, "pricing"), (RULE_PATHS, "rules")])
    return F.coalesce(by_url, F.when(key.startswith("rules"), "rules").otherwise("pricing"))


def texts(evidence: DataFrame, id_col: str = "evidence_id", blocks: bool = True) -> DataFrame:
    """evidence (key, source_url, raw) with `text`: JSON as canonical text; of pages the blocks under headings on their kind, else all of their text."""
    page = X.html_text(F.col("raw"))
    out = evidence.withColumn("__kind", kind(F.col("source_url"), F.col("key")))
    if blocks:
        of = lambda name, words: K.heading_blocks(out.filter((F.col("__kind") == name) & (F.col("key") != "xhr_json")), id_col, "raw", words)
        out = out.join(of("rules", RULE_BLOCKS).unionByName(of("pricing", PRICING_BLOCKS)), id_col, "left")
        page = F.coalesce(F.nullif(F.trim("block"), F.lit("")), page)
    json = F.when(F.col("key") == "xhr_json", F.col("raw"))  # Python sees every row, but no page's text
    text = F.when(F.col("key") == "xhr_json", J.json_text(json)).otherwise(page)
    return out.withColumn("text", text).select(*evidence.columns, "text")


def first_hits(evidence: DataFrame, blocks: bool = True, parsed: list | None = None) -> DataFrame:
    """firm_id, target, place, evidence_id, source_url, sha256, payout_frequency, ... : the datapoints of rules and pricing.

    evidence: evidence_id (unique), firm_id, key, source_url, sha256, created_at, raw. A firm's evidence is read newest
    first (equal times by evidence_id); texts under SHORTEST characters give nothing. Each text of a target's keys gives a
    datapoint until one has any of the target's fields; nothing is read after both targets have one.

    Texts are read in rounds of one, two, four ... further places, only for firms that miss a target, so a firm's texts
    are at most twice those up to its last hit, and a firm with many is read by many tasks. Places come from a rank that
    is cut before the shuffle, of columns without the texts. parsed: a list that takes the number of texts of each round.
    """
    rules, pricing, both = (F.col("key").isin(x) for x in (RULE_KEYS, PRICING_KEYS, BOTH_KEYS))
    rows = evidence.filter((rules | pricing | both) & F.col("raw").isNotNull())
    none = F.lit(None).cast("long")
    firms = rows.groupBy("firm_id").agg(F.count("*").alias("n")).withColumns({"rules_at": none, "pricing_at": none})
    order = Window.partitionBy("firm_id").orderBy(F.desc("created_at"), "evidence_id")
    found, open_, low, size = None, kept(firms), 1, 1
    while True:
        high = low + size - 1
        narrow = rows.join(open_.select("firm_id"), "firm_id", "left_semi").select("firm_id", "evidence_id", "created_at")
        picked = narrow.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= high).filter(F.col("place") >= low).select("evidence_id", F.col("place").cast("long").alias("place"))
        read = texts(rows.join(picked, "evidence_id"), blocks=blocks)
        r, p = E.extracted_rules(F.col("text")), E.extracted_pricing(F.col("text"))
        got = read.filter(F.length("text") >= SHORTEST).select("firm_id", "place", "evidence_id", "source_url", "sha256", (rules | both).alias("for_rules"), (pricing | both).alias("for_pricing"), r.alias("rules"), p.alias("pricing"))
        has = lambda c, names: F.coalesce(*(F.when(F.col(f"{c}.{n}").isNotNull(), True) for n in names), F.lit(False))
        got = kept(got.withColumns({"has_rules": F.col("for_rules") & has("rules", J.RULE_FIELDS), "has_pricing": F.col("for_pricing") & has("pricing", J.PRICING_FIELDS)}))
        if parsed is not None:
            parsed.append(picked.count())
        first = got.groupBy("firm_id").agg(F.min(F.when(F.col("has_rules"), F.col("place"))).alias("r"), F.min(F.when(F.col("has_pricing"), F.col("place"))).alias("p"))
        state = open_.join(first, "firm_id", "left").select("firm_id", "n", F.coalesce("rules_at", "r").alias("rules_at"), F.coalesce("pricing_at", "p").alias("pricing_at"))
        state = kept(state)
        late = lambda at: F.coalesce(F.col("place") <= F.col(at), F.lit(True))
        end = F.greatest("rules_at", "pricing_at")  # of one that is missing the other's place doesn't end the reading
        read_ = got.join(state, "firm_id").filter(F.col("rules_at").isNull() | F.col("pricing_at").isNull() | (F.col("place") <= end))
        of = lambda name, cond, at: read_.filter(F.col(cond) & late(at)).select("firm_id", F.lit(name).alias("target"), "place", "evidence_id", "source_url", "sha256", *(F.col(f"{name}.{c}").alias(c) if c in (J.RULE_FIELDS if name == "rules" else J.PRICING_FIELDS) else F.lit(None).cast(t).alias(c) for c, t in J.FIELD_TYPES.items()))
        new = of("rules", "for_rules", "rules_at").unionByName(of("pricing", "for_pricing", "pricing_at"))
        before = open_.select("firm_id", F.col("rules_at").alias("__r"), F.col("pricing_at").alias("__p"))
        new = kept(new.join(before, "firm_id").filter(F.when(F.col("target") == "rules", F.col("__r")).otherwise(F.col("__p")).isNull()).drop("__r", "__p"))
        found = new if found is None else found.unionByName(new)
        open_ = kept(state.filter("rules_at IS NULL OR pricing_at IS NULL").filter(F.col("n") > high))
        low, size = high + 1, size * 2
        if open_.isEmpty():
            return found


def runs(evidence: DataFrame, datapoints: DataFrame) -> DataFrame:
    """firm_id, processed (texts up to the last that is read), rules and pricing (1 if a datapoint has any of their fields) of each firm with evidence."""
    any_ = lambda fields: F.coalesce(*(F.when(F.col(f).isNotNull(), True) for f in fields), F.lit(False))
    of = lambda name, fields: F.min(F.when((F.col("target") == name) & any_(fields), F.col("place")))
    hits = datapoints.groupBy("firm_id").agg(of("rules", J.RULE_FIELDS).alias("r"), of("pricing", J.PRICING_FIELDS).alias("p"))
    n = evidence.filter(F.col("key").isin(RULE_KEYS + PRICING_KEYS + BOTH_KEYS) & F.col("raw").isNotNull()).groupBy("firm_id").agg(F.count("*").alias("n"))
    both = F.col("r").isNotNull() & F.col("p").isNotNull()
    return n.join(hits, "firm_id", "left").select("firm_id", F.when(both, F.greatest("r", "p")).otherwise(F.col("n")).alias("processed"), F.col("r").isNotNull().cast("int").alias("rules"), F.col("p").isNotNull().cast("int").alias("pricing"))


def merged_parts(parts: DataFrame, keys: list[str], place: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """One row for each key: of each scalar the first value, by place, that isn't null or blank; of each list all distinct values in order of their first place.

    Values are taken by aggregates that tasks merge: the first value of a scalar is a minimum of (place, value), and a
    list's values are first reduced to one row each with its first place, so that no row holds a key's parts. Null and
    empty lists give an empty list. Places must differ within a key.
    """
    d = parts.select(*keys, F.col(place).alias("__at"), *scalars, *lists)
    known = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    out = d.groupBy(*keys).agg(*(F.min(F.when(known(c), F.struct("__at", F.col(c).alias("v")))).alias(c) for c in scalars), F.count("*").alias("parts"))
    out = out.select(*keys, *(F.col(c)["v"].alias(c) for c in scalars), "parts")
    for c in lists:
        items = d.select(*keys, "__at", F.posexplode(c).alias("__i", "__v")).filter("__v IS NOT NULL").groupBy(*keys, "__v").agg(F.min(F.struct("__at", "__i")).alias("__first"))
        union = items.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("__first", "__v"))), lambda x: x["__v"]).alias(c))  # its distinct values are the result's
        out = out.join(union, keys, "left").withColumn(c, F.coalesce(c, F.array().cast(d.schema[c].dataType)))
    return out.select(*keys, *scalars, *lists, "parts")


def field_winners(rows: DataFrame, key: str, fields: list[str], source: str, trust: dict[str, int], *order: str) -> DataFrame:
    """key, each field, and `sources` (map of field to source) from rows of several sources.

    Of each field the value wins that isn't null or blank and comes from the source of the highest trust (sources that
    aren't listed come last), then by the order columns. Keys without any value have no row. The fields are unpivoted to
    rows of (key, field, value), reduced to one each by a mergeable minimum, and pivoted back.
    """
    kinds = {f: rows.schema[f].dataType for f in fields}
    rank = F.lit(0)
    for name, t in trust.items():
        rank = F.when(F.col(source) == name, -t).otherwise(rank)
    cells = F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields))
    long = rows.select(F.col(key).alias("__k"), rank.alias("__t"), F.struct(*order).alias("__o"), F.col(source).alias("__s"), F.explode(cells).alias("c")).filter("c.v <> ''")
    best = long.groupBy("__k", F.col("c.f").alias("f")).agg(F.min(F.struct("__t", "__o", "__s", F.col("c.v").alias("v"))).alias("m"))
    one = best.groupBy("__k").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("f", F.col("m.v").alias("v"))))).alias("v"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("f", F.col("m.__s").alias("s"))))).alias("sources"))  # a row for each field
    return one.select(F.col("__k").alias(key), *(F.try_element_at("v", F.lit(f)).cast(kinds[f]).alias(f) for f in fields), "sources")


def filled(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows to write: key, fields (an old value that isn't null or blank stays, gaps are filled) and `action`, insert or update.

    Rows that new doesn't change are left out, so a second run writes nothing. One row a key on each side.
    """
    a, b = old.select(key, *(F.col(f).alias(f"__old_{f}") for f in fields), F.lit(True).alias("__held")), new.select(key, *fields)
    gap = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    joined = b.join(a, key, "left")
    merged = joined.select(key, *(F.when(gap(f"__old_{f}") & ~gap(f), F.col(f)).otherwise(F.col(f"__old_{f}")).alias(f) for f in fields), "__held", *(f"__old_{f}" for f in fields))
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~F.col(f).eqNullSafe(F.col(f"__old_{f}"))
    return merged.filter(changed).select(key, *fields, F.when(F.col("__held"), "update").otherwise("insert").alias("action"))


def ranked_candidates(rows: DataFrame, key: str, url: str, trust: Column, place: str, most: int = 10) -> DataFrame:
    """Each key's distinct addresses, the most trusted first (equal trust by place), `most` of them at most; rank from 1."""
    one = rows.groupBy(key, url).agg(F.max(F.struct(trust.alias("t"), (-F.col(place)).alias("p"))).alias("m"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("m.t"), F.desc("m.p")))
    return one.withColumn("rank", rank).filter(F.col("rank") <= most).select(key, url, F.col("m.t").alias("trust"), F.col("rank").cast("long").alias("rank"))
