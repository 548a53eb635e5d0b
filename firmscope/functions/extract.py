"""Fields read from the text of pages, registries and watchlists, as column expressions.

Order matters in most of these rules: the first that applies wins, as the tables below list them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, patterns and bands that results depend on.
FREQUENCIES = [("on demand", "on_demand"), ("on-demand", "on_demand"), ("daily", "daily"), ("weekly", "weekly"), ("biweekly", "biweekly"), ("bi-weekly", "biweekly"), ("monthly", "monthly"), ("quarterly", "quarterly"), ("annually", "annually"), ("yearly", "annually")]
PAYOUT_EVERY = r"(?:payouts?|withdrawals?)\s+(?:are\s+)?(?:processed|paid|available)?\s*(?:every|within|after)\s+([0-9]{1,2})\s+days?"
ANY_EVERY = r"(?:every|within|after)\s+([0-9]{1,2})\s+(day|week|month)s?"
DAY_BANDS = [(1, "daily"), (7, "weekly"), (14, "biweekly"), (31, "monthly")]
RULE_CHANGE = r"rules? (change|update)[^\n]{0,40}(daily|weekly|monthly|quarterly|annually|yearly)"
MAX_DRAWDOWN = ["max drawdown", "maximum drawdown", "overall drawdown", "total drawdown", "max loss", "maximum loss", "drawdown limit", "loss limit"]
DAILY_DRAWDOWN = ["daily drawdown", "daily loss", "daily loss limit", "loss limit per day"]
PROFIT_SPLIT = r"profit\s+split[^0-9]{0,12}([0-9]{1,3})\s*%"
FOUNDED = r"(?:founded|established|since|launched|incorporated)\s*(?:in\s*)?(19[0-9]{2}|20[0-9]{2})"
HEADQUARTERS = [r"headquartered\s+in\s+([A-Za-z][A-Za-z\-\.\s]{2,60})", r"head office\s+in\s+([A-Za-z][A-Za-z\-\.\s]{2,60})", r"based\s+in\s+([A-Za-z][A-Za-z\-\.\s]{2,60})"]
DELAYS = [(("on_demand", "on demand", "instant"), 0), (("biweekly", "bi-weekly", "fortnight"), 14), (("weekly",), 7), (("monthly",), 30), (("daily",), 1)]
CHANGE_LEVELS = [("low", 1), ("rare", 1), ("stable", 1), ("medium", 2), ("moderate", 2), ("monthly", 2), ("weekly", 3), ("high", 4), ("frequent", 4), ("daily", 4)]
NORMAL_FREQUENCIES = [(("on demand",), "on_demand"), (("daily",), "daily"), (("biweekly", "bi weekly"), "biweekly"), (("weekly",), "weekly"), (("monthly",), "monthly"), (("quarterly",), "quarterly"), (("annually", "yearly"), "yearly")]
TIER_ONE = ["united states", "usa", "canada", "united kingdom", "uk", "australia", "new zealand", "singapore", "japan", "germany", "france", "netherlands", "switzerland", "austria", "sweden", "norway", "denmark", "finland", "ireland"]
COUNTRY_OF_TLD = {
    "co.uk": "United Kingdom", "uk": "United Kingdom", "com.au": "Australia", "au": "Australia", "ca": "Canada", "us": "United States",
    "ie": "Ireland", "fr": "France", "de": "Germany", "es": "Spain", "it": "Italy", "nl": "Netherlands", "be": "Belgium",
    "se": "Sweden", "no": "Norway", "dk": "Denmark", "fi": "Finland", "ch": "Switzerland", "at": "Austria", "pl": "Poland",
    "cz": "Czech Republic", "pt": "Portugal", "sg": "Singapore", "hk": "Hong Kong", "jp": "Japan", "cn": "China", "in": "India",
    "br": "Brazil", "mx": "Mexico", "za": "South Africa", "ae": "United Arab Emirates", "eu": "European Union",
    "io": "International", "com": "Global", "net": "Global", "org": "Global", "co": "Global",
}
STATUS_WORDS = [(("active", "registered", "open"), "active"), (("suspended", "revoked"), "suspended"), (("dissolved", "inactive", "liquidated", "closed"), "expired")]
EVENT_WORDS = [(("suspend", "suspension"), "suspension"), (("revok", "withdraw"), "revocation"), (("settlement", "fine", "penalty"), "settlement"), (("enforcement", "action", "proceeding"), "enforcement")]
SEVERITY_WORDS = [(("revok", "ban", "suspend", "criminal", "fraud"), "critical"), (("enforcement", "penalty", "fine"), "high"), (("warning", "alert"), "medium")]

NEWS_EVENTS = [(("enforcement", "penalty", "fine"), "ENFORCEMENT"), (("warning", "alert"), "WARNING"), (("filing", "sec"), "FILING")]
NEWS_SEVERITIES = [(("fraud", "suspended", "revoked"), "CRITICAL"), (("enforcement", "violation"), "HIGH"), (("warning", "investigation"), "MEDIUM")]


def first_word(c: Column, table: list[tuple[tuple[str, ...] | str, object]], otherwise=None) -> Column:
    """The value beside the first entry of the table of which any word lies in c."""
    out = F.lit(otherwise)
    for words, value in reversed(table):
        words = (words,) if isinstance(words, str) else words
        hit = F.lit(False)
        for w in words:
            hit = hit | c.contains(w)
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def _group(c: Column, pattern: str, n: int) -> Column:
    """A group of the first match, null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))


def _bands(days: Column) -> Column:
    out = F.lit(None).cast("string")
    for limit, name in reversed(DAY_BANDS):
        out = F.when(days <= limit, name).otherwise(out)
    return out


def payout_frequency(c: Column) -> Column:
    """How often a text says it pays out: by word, else by interval; null unless payouts or withdrawals are mentioned.

    Words are looked for in the order of FREQUENCIES, so "biweekly" reads as weekly, which it contains, and "bi-weekly" too.
    """
    low = F.lower(c)
    days, n, unit = _group(low, PAYOUT_EVERY, 1).cast("int"), _group(low, ANY_EVERY, 1).cast("int"), F.regexp_extract(low, ANY_EVERY, 2)
    weeks = F.when(n == 1, "weekly").when(n == 2, "biweekly").when(n >= 4, "monthly")
    months = F.when(n == 1, "monthly").when(n == 3, "quarterly").when(n >= 12, "annually")
    every = F.coalesce(_bands(days), F.when(unit == "day", _bands(n)).when(unit == "week", weeks).when(unit == "month", months))
    return F.when(low.contains("payout") | low.contains("withdraw"), F.coalesce(first_word(low, FREQUENCIES), every))


def delay_days(frequency: Column) -> Column:
    """Days until money arrives, from the name of a frequency."""
    return first_word(F.lower(frequency), DELAYS).cast("int")


def normal_frequency(c: Column) -> Column:
    return first_word(F.replace(F.lower(F.trim(c)), F.lit("-"), F.lit(" ")), NORMAL_FREQUENCIES)


def change_level(c: Column) -> Column:
    """1 (rare) to 4 (daily) from words on how often rules change."""
    return first_word(F.lower(F.trim(c)), CHANGE_LEVELS).cast("int")


def percent_near(c: Column, label: str, gap: int = 40, digits: int = 3) -> Column:
    """The number before a % within `gap` characters after the label, none of them a digit."""
    return _group(c, rf"(?i){label}[^0-9]{{0,{gap}}}([0-9]{{1,{digits}}}(?:\.[0-9]{{1,2}})?)\s*%", 1).try_cast("double")


def first_percent(c: Column, labels: list[str], gap: int = 40, digits: int = 3) -> Column:
    """percent_near of the first label that has a number other than zero; the last label may give zero."""
    found = [percent_near(c, x, gap, digits) for x in labels]
    return F.coalesce(*(F.nullif(x, F.lit(0.0)) for x in found[:-1]), found[-1])


def rule_change(c: Column) -> Column:
    return F.lower(_group(c, f"(?i){RULE_CHANGE}", 2))


def extracted_rules(c: Column) -> Column:
    """struct of the rules a text states: payout_frequency, max_drawdown, daily_drawdown, rule_changes_frequency."""
    return F.struct(payout_frequency(c).alias("payout_frequency"), first_percent(c, MAX_DRAWDOWN).alias("max_drawdown"), first_percent(c, DAILY_DRAWDOWN).alias("daily_drawdown"), rule_change(c).alias("rule_changes_frequency"))


def extracted_pricing(c: Column) -> Column:
    return F.struct(payout_frequency(c).alias("payout_frequency"), _group(F.lower(c), PROFIT_SPLIT, 1).try_cast("double").alias("payout_split_pct"))


def founded_year(c: Column) -> Column:
    return _group(c, f"(?i){FOUNDED}", 1).cast("int")


def headquarters(c: Column) -> Column:
    """The place after "headquartered in", "head office in" or "based in", without outer blanks and marks."""
    return F.coalesce(*(F.nullif(F.trim(F.regexp_replace(F.trim(F.regexp_extract(c, f"(?i){p}", 1)), r"^[.,;]+|[.,;]+$", "")), F.lit("")) for p in HEADQUARTERS))


def first_number(c: Column) -> Column:
    return _group(c, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def numeric(c: Column) -> Column:
    """A number with or without a % sign; null for anything else."""
    return F.replace(F.trim(c), F.lit("%"), F.lit("")).try_cast("double")


def registry_status(c: Column) -> Column:
    """active, suspended, expired or unknown; "inactive" holds "active" and reads so."""
    return first_word(F.lower(c), STATUS_WORDS, "unknown")


def event_type(title: Column) -> Column:
    return first_word(F.lower(title), EVENT_WORDS, "warning")


def severity(title: Column) -> Column:
    return first_word(F.lower(title), SEVERITY_WORDS, "low")


def news_event(title: Column) -> Column:
    """Kind of a news item: ENFORCEMENT, WARNING, FILING or NEWS."""
    return first_word(F.lower(title), NEWS_EVENTS, "NEWS")


def news_severity(title: Column, description: Column) -> Column:
    return first_word(F.lower(F.concat_ws(" ", title, description)), NEWS_SEVERITIES, "LOW")


def jurisdiction_tier(c: Column, skip_global: bool = True) -> Column:
    """Tier 1 to 3 from a jurisdiction's name by substrings, in order; null for blank and, with skip_global, for global ones."""
    low = F.lower(c)
    other = F.when(low.contains("eu"), "Tier 2").when(low.contains("offshore") | low.contains("islands"), "Tier 3").otherwise("Tier 2")
    tier = first_word(low, [(tuple(TIER_ONE), "Tier 1")])
    out = F.when(F.coalesce(c, F.lit("")) != "", F.coalesce(tier, other))
    return F.when(low.contains("global"), None).otherwise(out) if skip_global else out


def url_host(url: Column) -> Column:
    """Host name in lower case, with or without a scheme in front; no port, user or path."""
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    return F.lower(F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def url_country(url: Column) -> Column:
    """Country by the last two labels of the host, else by the last; international endings give Global or International."""
    p = F.split(url_host(url), r"\.")
    of = F.create_map(*(F.lit(x) for kv in COUNTRY_OF_TLD.items() for x in kv))
    return F.coalesce(F.try_element_at(of, F.array_join(F.slice(p, F.greatest(F.size(p) - 1, F.lit(1)), F.lit(2)), ".")), F.try_element_at(of, F.element_at(p, -1)))


def firm_id(host: Column, name: Column) -> Column:
    """A slug of the host without www, dots dropped; without a host a slug of the name."""
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\s+", "-"), r"[^a-z0-9\-_]", ""), "-+", "-")
    h = F.nullif(clean(F.regexp_replace(host, r"^www\.", "")), F.lit(""))
    return F.coalesce(h, F.nullif(clean(name), F.lit("")), F.lit("unknown"))


def quoted_aliases(remarks: Column) -> Column:
    """Names in double quotes after a.k.a., also known as, f.k.a. and formerly known as: by phrase, then place; each once."""
    marks = [r"a\.k\.a\.", "also known as", r"f\.k\.a\.", "formerly known as"]
    found = F.concat(*(F.regexp_extract_all(remarks, F.lit(rf'(?i){m}\s+"([^"]+)"'), F.lit(1)) for m in marks))
    return F.array_distinct(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.trim(x)))


def nationality(remarks: Column) -> Column:
    return F.array_compact(F.array(_group(remarks, r"(?i)nationality\s+([A-Z]{2,3})", 1)))


def entity_type(kind: Column) -> Column:
    return first_word(F.lower(kind), [("individual", "individual"), ("vessel", "vessel"), ("aircraft", "aircraft")], "entity")


def full_name(*parts: Column) -> Column:
    """The parts that aren't blank, joined; UNKNOWN if there are none."""
    return F.coalesce(F.nullif(F.trim(F.concat_ws(" ", *(F.nullif(p, F.lit("")) for p in parts))), F.lit("")), F.lit("UNKNOWN"))


def separators_dropped(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def rss_date(c: Column) -> Column:
    """Timestamp of an RFC-822 date; null if it is none."""
    return F.coalesce(F.try_to_timestamp(F.regexp_replace(c, r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]{3},\s*", ""), r"\s*(GMT|UT|UTC|Z)$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z")))
