"""Addresses and slugs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words misspelt in paths, words of addresses to leave out, and what slugs end with.
TYPOS = {"princing": "pricing", "prcing": "pricing", "pricng": "pricing", "tradding": "trading", "tradng": "trading", "challange": "challenge", "chalenge": "challenge", "withdawal": "withdrawal", "withdrawl": "withdrawal"}
UNWANTED = ["blog", "news", "press", "affiliate", "partners", "cookie", "privacy", "login", "signup", "register", "careers", "jobs", "contact", "support-ticket"]
SUFFIXES = ["prop", "propfirm", "funded", "trading", "capital", "markets", "group"]
RULE_WORDS = ["rule", "rules", "faq", "terms", "conditions", "payout", "withdraw", "refund", "policy", "agreement", "legal", "trading-rules", "consistency", "drawdown"]
FALLBACKS = ["/rules", "/trading-rules", "/rulebook", "/faq", "/faqs", "/help", "/terms", "/terms-and-conditions", "/legal", "/agreement", "/policies", "/payout", "/payouts", "/withdrawal", "/refund", "/fees"]
FORMS = ["prop-firm", "propfirm", "prop-trading-firm"]


def repaired(url: Column) -> Column:
    """The address and its likely forms, each once: single slashes, with and without one at the end, known typos, www, the other scheme."""
    scheme, host = F.regexp_extract(url, "^([a-z]+)://", 1), F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)
    raw, rest = F.regexp_extract(url, "^[a-z]+://[^/?#]*([^?#]*)", 1), F.regexp_extract(url, "^[a-z]+://[^/?#]*[^?#]*(.*)$", 1)
    path = F.coalesce(F.nullif(raw, F.lit("")), F.lit("/"))
    clean = F.regexp_replace(path, "/{2,}", "/")
    with_path = lambda p: F.concat(scheme, F.lit("://"), host, p, rest)
    slash = F.when(clean.endswith("/") & (clean != "/"), F.regexp_replace(clean, "/+$", "")).otherwise(F.concat(clean, F.lit("/")))
    typos = [F.when(clean.contains(a), with_path(F.replace(clean, F.lit(a), F.lit(b)))) for a, b in TYPOS.items()]
    www = F.concat(scheme, F.lit("://"), F.when(host.startswith("www."), F.substr(host, F.lit(5))).otherwise(F.concat(F.lit("www."), host)), raw, rest)
    other = F.concat(F.when(scheme == "http", "https").when(scheme == "https", "http").otherwise(scheme), F.lit("://"), host, raw, rest)
    forms = F.array_distinct(F.array_compact(F.array(url, F.when(clean != path, with_path(clean)), with_path(slash), *typos, www, other)))
    return F.when(F.coalesce(url, F.lit("")) != "", forms).otherwise(F.array().cast("array<string>"))


def slug_forms(slug: Column) -> Column:
    """A slug and its likely forms, each once: without a common ending, without prop, without hyphens, with endings of firms."""
    parts = F.split(slug, "-")
    last = F.element_at(parts, -1)
    shorter = F.when((F.size(parts) > 1) & last.isin(SUFFIXES), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "-"))
    bare = F.when((F.size(parts) > 1) & F.array_contains(parts, "prop"), F.nullif(F.array_join(F.array_remove(parts, "prop"), "-"), F.lit("")))
    joined = F.when(slug.contains("-"), F.replace(slug, F.lit("-"), F.lit("")))
    ends = [F.concat(slug, F.lit(f"-{x}")) for x in FORMS]
    return F.when(F.coalesce(slug, F.lit("")) != "", F.array_distinct(F.array_compact(F.array(slug, shorter, bare, joined, *ends)))).otherwise(F.array().cast("array<string>"))


def address_host(c: Column | str) -> Column:
    """What stands between // and the path: user, host and port; blank without it."""
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def joined_address(base: Column, href: Column) -> Column:
    """The address that a link on the page `base` leads to, by the published rules for relative references."""
    part = lambda c, n: F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$", n)
    scheme, host, path, query = (part(base, n) for n in (1, 2, 3, 4))
    h_path, h_rest = part(href, 3), F.concat(part(href, 4), part(href, 5))
    folder = F.when((host != "") & (path == ""), F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    whole = F.when(h_path.startswith("/"), h_path).otherwise(F.concat(folder, h_path))
    inside = F.when(h_path == "", F.concat(path, F.when(part(href, 4) == "", query).otherwise(F.lit("")))).otherwise(without_dots(whole))
    return F.when(href == "", base).when(part(href, 1) != "", href).when(part(href, 2) != "", F.concat(scheme, href)).otherwise(F.concat(scheme, host, inside, h_rest))


def without_dots(path: Column) -> Column:
    """A path whose . and .. segments are worked out."""
    steps = F.split(path, "/")
    back = lambda done: F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == ".", done).when(s == "..", back(done)).otherwise(F.concat(done, F.array(s))))
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(steps, -1).isin(".", ".."), "/").otherwise(""))


def candidates(base: Column, paths: list[str], found: Column | None = None, most: int | None = None) -> Column:
    """The page itself, the paths on its host, and found addresses (array), each once and in this order; `most` of them at most."""
    own = F.array(base, *(joined_address(base, F.lit(f"/{p.lstrip('/')}")) for p in paths))
    every = F.array_distinct(own if found is None else F.concat(own, F.coalesce(found, F.array().cast("array<string>"))))
    return every if most is None else F.slice(every, 1, most)
