"""Links, headings and search results: rows read from pages, ranks, and joins by host."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from firmscope.functions import text as X
from firmscope.functions.pages import FALLBACKS, RULE_WORDS, UNWANTED, address_host, joined_address

_AROUND = {"nav", "header", "footer", "li", "section", "div"}
_EMPTY = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_SILENT = {"script", "style", "noscript", "svg"}


class _Page(HTMLParser):
    """Links with their text and that of the nearest element around, and the text under each heading.

    A heading's text ends at the next heading or where the element that holds the heading ends.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = [("", [])]
        self.links: list[tuple[str, list[str], list[str] | None]] = []
        self.blocks: list[tuple[list[str], list[str]]] = []
        self.heading: tuple[list[str], list[str], int] | None = None
        self.in_heading = False

    def handle_starttag(self, tag, attrs):
        if tag in _EMPTY:
            return
        if tag in ("h1", "h2", "h3", "h4"):
            self.heading = ([], [], len(self.open))
            self.blocks.append(self.heading[:2])
            self.in_heading = True
        own: list[str] = []
        if tag == "a" and (href := dict(attrs).get("href")):
            around = next((x for name, x in reversed(self.open) if name in _AROUND), None)
            self.links.append((href, own, around))
        self.open.append((tag, own))

    def handle_endtag(self, tag):
        if tag in ("h1", "h2", "h3", "h4"):
            self.in_heading = False
        if any(name == tag for name, _ in self.open[1:]):
            while self.open.pop()[0] != tag:
                pass
            if self.heading and len(self.open) < self.heading[2]:
                self.heading = None

    def handle_data(self, data):
        if not (data := data.strip()) or any(name in _SILENT for name, _ in self.open):
            return
        for _, own in self.open:
            own.append(data)
        if self.heading:
            self.heading[0 if self.in_heading else 1].append(data)


def _parsed(html: str | None) -> _Page:
    p = _Page()
    p.feed(html or "")
    p.close()
    return p


#: Pages that a task parses at once: their rows leave Python before the next are read.
PAGES = 64


def _page_rows(pages: DataFrame, id_col: str, html_col: str, of: Callable[[_Page], list[tuple]], fields: str) -> DataFrame:
    """id and the rows that `of` reads from each parsed page. Of a batch only PAGES pages at a time become Python texts."""
    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), *T._parse_datatype_string(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES):
                b = whole.slice(at, PAGES)
                found = [(i, r) for i, html in enumerate(b.column(1).to_pylist()) for r in of(_parsed(html))]
                ids = b.column(0).take(pa.array([i for i, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for _, r in found], kind) for k, kind in enumerate(to_arrow_schema(schema).types[1:]))], names=schema.names)

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def page_anchors(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, at (place in the page, from 0), href, text and around (the text of the nearest list item, section, division or the like; null without one) of every link."""
    of = lambda p: [(at, href, " ".join(own), None if around is None else " ".join(around)) for at, (href, own, around) in enumerate(p.links)]
    return _page_rows(pages, id_col, html_col, of, "at long, href string, text string, around string")


def keyword_links(pages: DataFrame, id_col: str, url_col: str, html_col: str, keywords: list[str], unwanted: list[str] = UNWANTED) -> DataFrame:
    """id, link, score, rank of a page's links to its own host that a keyword speaks for, each once with its best score.

    6 for a keyword in the address, 4 in the link's text, 2 in the text of the nearest list item, section, division or
    the like around it. Links with an unwanted word, and those within the page or to a mail address or script, are left
    out. Rank: by score, then place in the page. Ids must be unique.
    """
    has = lambda c, words: F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: F.lower(c).contains(w)), F.lit(False))
    points = lambda c, n: F.when(has(F.col(c), keywords), n).otherwise(0)
    base = F.coalesce("__base", F.lit(""))
    rows = page_anchors(pages, id_col, html_col).join(pages.select(id_col, F.col(url_col).alias("__base")), id_col)
    rows = rows.filter(~F.col("href").rlike("^(#|mailto:|javascript:)")).withColumn("link", joined_address(base, F.col("href")))
    rows = rows.filter((F.lower(address_host("link")) == F.lower(address_host(base))) & ~has(F.col("link"), unwanted))
    scored = rows.withColumn("score", (points("link", 6) + points("text", 4) + points("around", 2)).cast("long")).filter("score > 0")
    one = scored.groupBy(id_col, "link").agg(F.max(F.struct("score", (-F.col("at")).alias("a"))).alias("m"))
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("m.score"), F.desc("m.a")))  # the links of one page
    return one.withColumn("rank", rank.cast("long")).select(id_col, "link", F.col("m.score").alias("score"), "rank")


def rule_links(pages: DataFrame, id_col: str, url_col: str, html_col: str, keywords: list[str] = RULE_WORDS, fallbacks: list[str] = FALLBACKS, most: int | None = 20) -> DataFrame:
    """id, link, rank: a page's links with a keyword in their address, in order, then the usual paths of its host, each once.

    The first `most` of them (a top-k of the feature), or all for None. Ids must be unique.
    """
    base = F.coalesce("__base", F.lit(""))
    own = pages.select(id_col, F.col(url_col).alias("__base"))
    rows = page_anchors(pages, id_col, html_col).filter(~F.col("href").rlike("^(#|mailto:|javascript:)")).join(own, id_col).withColumn("link", joined_address(base, F.col("href")))
    spoken = rows.filter(F.exists(F.array(*map(F.lit, keywords)), lambda w: F.lower("link").contains(w))).select(id_col, "link", F.col("at"))
    usual = own.select(id_col, F.posexplode(F.array(*(joined_address(base, F.lit(p)) for p in fallbacks))).alias("at", "link")).filter(address_host("link") != "").select(id_col, "link", (F.col("at") + (1 << 40)).alias("at"))
    one = spoken.unionByName(usual).groupBy(id_col, "link").agg(F.min("at").alias("at"))
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy("at"))
    out = one.withColumn("rank", rank.cast("long"))
    return (out if most is None else out.filter(F.col("rank") <= most)).select(id_col, "link", "rank")


def heading_blocks(pages: DataFrame, id_col: str, html_col: str, keywords: list[str]) -> DataFrame:
    """id and block: the headings that have a keyword, each with the text under it, joined by blanks; pages without one have no row."""

    def of(p: _Page) -> list[tuple[str]]:
        blocks = [" ".join([*title, *under]) for title, under in p.blocks if any(k in " ".join(title).lower() for k in keywords)]
        return [(" ".join(blocks),)] if blocks else []

    return _page_rows(pages, id_col, html_col, of, "block string")


def best_per_key(rows: DataFrame, key: Column, relevance: Column, place: Column) -> DataFrame:
    """The most relevant row of each key, of equal ones the first."""
    w = Window.partitionBy("__k").orderBy(relevance.desc(), place)
    return rows.withColumn("__k", key).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__k", "__r")


def relevance(query: Column, title: Column, snippet: Column, rank: Column, source: Column) -> Column:
    """0 to 1: by place (0.4, 0.3 to the third, 0.2 to the fifth, 0.1), 0.3 and 0.2 for the query's words in title and snippet, and the source's own."""
    words = lambda c: F.array_distinct(F.array_remove(F.split(F.lower(c), r"\s+"), ""))
    q = words(query)
    part = lambda c: F.size(F.array_intersect(q, words(c))) / F.greatest(F.size(q), F.lit(1))
    place = F.when(rank == 1, 0.4).when(rank <= 3, 0.3).when(rank <= 5, 0.2).otherwise(0.1)
    return F.least(F.lit(1.0), place + 0.3 * part(title) + 0.2 * part(snippet) + source)


def full_text(rows: DataFrame, id_col: str, text: Column, query: str, top: int) -> DataFrame:
    """id and hits of the `top` rows that hold all words of the query, by how often; words as they are, without stems."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    asked = sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})
    d = rows.withColumn("__w", words)
    for w in asked:
        d = d.filter(F.array_contains("__w", w))
    hits = F.size(F.filter("__w", lambda x: x.isin(asked))).cast("long")
    return d.withColumn("hits", hits).orderBy(F.desc("hits"), id_col).limit(top).select(id_col, "hits")


def trigram_top(queries: DataFrame, entities: DataFrame, least: float, top: int) -> DataFrame:
    """query_id, entity_id, score of each query's `top` entities by trigram similarity of `least` or more.

    Of n trigrams a name of that similarity shares `least` * n at least, so it has one of any n - that + 1 of them: the
    rarest are looked up.
    """
    q = queries.select("query_id", X.trigrams(F.col("name")).alias("x"))
    e = entities.select("entity_id", X.trigrams(F.col("name")).alias("y"))
    names, others = q.select("x").distinct(), e.select("y").distinct()
    index = others.select("y", F.explode("y").alias("g"))
    often = index.groupBy("g").agg(F.count("*").alias("df"))
    asked = names.select("x", F.explode("x").alias("g")).join(often, "g", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("x").orderBy("df", "g"))  # the trigrams of one name
    rare = asked.withColumn("place", place).filter(F.col("place") <= F.size("x") - F.ceil(F.lit(least) * F.size("x") - 1e-9) + 1)
    a, b = F.size("x"), F.size("y")
    pairs = rare.select("x", "g").join(index, "g").filter(F.least(a, b) >= least * F.greatest(a, b) - 1e-9).select("x", "y").distinct()
    scored = pairs.withColumn("score", F.round(F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y")), 6)).filter(F.col("score") >= least)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "entity_id"))
    found = q.join(scored, "x").join(e, "y").withColumn("r", rank).filter(F.col("r") <= top)
    return found.select("query_id", "entity_id", "score")


def host_join(rows: DataFrame, firms: DataFrame) -> DataFrame:
    """rows (with host) and the firm of the host, or of its last two or three labels: the first of these that a firm has; place says which (1 to 3)."""
    p = F.split("host", r"\.")
    last = lambda n: F.array_join(F.slice(p, F.greatest(F.size(p) - n + 1, F.lit(1)), F.lit(n)), ".")
    keys = rows.select("host").distinct().select("host", F.posexplode(F.array(F.col("host"), last(2), last(3))).alias("at", "k"))
    met = keys.join(firms.withColumnRenamed("host", "k"), "k").groupBy("host").agg(F.min(F.struct("at", "firm_id")).alias("m"))
    return rows.join(met, "host").select(*(c for c in rows.columns if c != "host"), F.col("m.firm_id").alias("firm_id"), (F.col("m.at") + 1).cast("long").alias("place"))
