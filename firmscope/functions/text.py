"""Names, similarity, identifiers and fields read from text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscope.functions import extract as E

#: Words that a company name may end with, and accents that are stripped.
LEGAL = "ltd|limited|inc|llc|plc|corp|corporation|company|co|gmbh|sa|ag"
LEGAL_SHORT = "ltd|limited|inc|llc|plc|corp|company|co"
ACCENTED, PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ", "aaaaaaeeeeiiiiooooouuuuncyy"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def name_delete(c: Column) -> Column:
    """Lower case; anything but letters, digits and blanks is deleted."""
    return squeeze(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", ""))


def name_space(c: Column) -> Column:
    """Lower case without accents; anything but letters and digits becomes a blank."""
    return squeeze(F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), r"[^a-z0-9]+", " "))


def name_no_suffix(c: Column, suffixes: str = LEGAL) -> Column:
    """As name_space, without legal suffixes."""
    return squeeze(F.regexp_replace(name_space(c), rf"\b({suffixes})\b", " "))


def slug(c: Column, most: int | None = None) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "&", "and"), r"[\s_]+", "-"), r"[^a-z0-9-]", "")
    s = F.regexp_replace(F.regexp_replace(s, "-+", "-"), "^-|-$", "")
    return F.coalesce(F.nullif(F.substring(s, 1, most) if most else s, F.lit("")), F.lit("unknown"))


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, r"[\s.\-]+"), "")


def soundex(c: Column) -> Column:
    """Four characters; vowels, H and W do not part equal codes; 0000 without letters."""
    u = F.regexp_replace(F.upper(c), "[^A-Z]", "")
    code = F.translate(u, "AEIOUYHWBFPVCGJKQSXZDTLMNR", "00000000111122222222334556")
    k = F.regexp_replace(F.regexp_replace(code, "0", ""), r"(.)\1+", "$1")
    rest = F.when(F.substring(code, 1, 1) == "0", k).otherwise(F.substring(k, 2, 99))
    return F.when(u == "", "0000").otherwise(F.rpad(F.substring(F.concat(F.substring(u, 1, 1), rest), 1, 4), 4, "0"))


def edit_similarity(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def tokens_met(x: Column, y: Column) -> Column:
    """Part of the tokens of the longer list that have one within an edit in the other."""
    hits = F.size(F.filter(x, lambda s: F.exists(y, lambda t: F.levenshtein(s, t) <= 1)))
    return hits / F.greatest(F.size(x), F.size(y), F.lit(1))


def token_similarity(a: Column, b: Column) -> Column:
    return tokens_met(tokens(a), tokens(b))


def similarity(a: Column, b: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """0.6 edit and 0.4 token similarity, 0.1 more if one contains the other, at most 1; equal strings 1. x, y: the tokens, if they are at hand."""
    met = token_similarity(a, b) if x is None else tokens_met(x, y)
    inside = F.when(a.contains(b) | b.contains(a), 0.1).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), 0.6 * edit_similarity(a, b) + 0.4 * met + inside))


def combined_similarity(a: Column, b: Column) -> Column:
    """0.7 similarity and 0.3 of 0.8 for names that sound alike."""
    return 0.7 * similarity(a, b) + 0.3 * F.when(soundex(a) == soundex(b), 0.8).otherwise(0.0)


def trigrams(c: Column) -> Column:
    """Distinct trigrams of each word, padded with two blanks before and one after."""
    words = F.array_remove(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " "), "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def percent_near(c: Column, label: str) -> Column:
    """The number before a % within 40 characters after the label, none of them a digit."""
    return F.expr("cast(null as double)") if not label else F.regexp_extract(F.lower(c), rf"{label}[^0-9]{{0,40}}([0-9]{{1,3}}(?:\.[0-9]{{1,2}})?)\s*%", 1).try_cast("double")


def first_year(c: Column, low: int = 1990, high: int = 2026) -> Column:
    years = F.transform(F.regexp_extract_all(c, F.lit(r"((?:19|20)[0-9]{2})"), F.lit(1)), lambda y: y.cast("int"))
    return F.get(F.filter(years, lambda y: y.between(low, high)), 0)


def frequency(c: Column) -> Column:
    """Payout frequency of a text by word, else by interval; null if it mentions neither payouts nor withdrawals."""
    return E.payout_frequency(c)


def delay_days(c: Column) -> Column:
    return E.delay_days(c)


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/:?#]+)", 1)), r"^www\.", "")


def host_suffixes(h: Column) -> Column:
    """The host, its last two and its last three labels, each once."""
    p = F.split(h, r"\.")
    last = lambda n: F.array_join(F.slice(p, F.greatest(F.size(p) - n + 1, F.lit(1)), F.lit(n)), ".")
    return F.array_distinct(F.array(h, last(2), last(3)))


def html_text(c: Column) -> Column:
    """Text of a page: scripts, styles and comments go, then tags; blanks are collapsed."""
    s = F.regexp_replace(c, r"(?is)<(script|style|noscript|svg)\b.*?</(script|style|noscript|svg)\s*>", " ")
    return squeeze(F.regexp_replace(F.regexp_replace(s, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " "))


def chunks(c: Column, size: int = 9000, most: int | None = None) -> Column:
    """Pieces of `size` characters of the whole text, or the first `most` of them."""
    n = F.ceil(F.length(c) / size).cast("int")
    n = n if most is None else F.least(n, F.lit(most))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(c, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def aliases(c: Column) -> Column:
    """Names after a.k.a. or f.k.a., in quotes, each once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[af]\.k\.a\.\s+'([^']+)'"), F.lit(1)))
