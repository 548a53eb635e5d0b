"""English words as search terms: stop words and the published Porter2 stemmer."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stop words of English full-text search, and the words and endings that the published stemmer names.
STOP = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves "
    "what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up down in out on off over under again further then once here there when where why how all any "
    "both each few more most other some such no nor not only own same so than too very s t can will just don should now"
).split()
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
UNCHANGED = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion"]
LI_BEFORE = "cdeghkmnrt"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")

_region = re.compile("[aeiouy][^aeiouy]")
_short_end = re.compile("(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _longest(w: str, endings) -> str:
    return max((x for x in endings if w.endswith(x)), key=len, default="")


def _after(w: str, start: int) -> int:
    """Where the region after the first vowel with a consonant behind it begins."""
    m = _region.search(w, start)
    return m.end() if m else len(w)


def stem(word: str) -> str:
    """The stem of a word in lower case; words of one or two letters and those with other signs than letters stay as they are."""
    if len(word) < 3 or not word.isascii() or not word.isalpha():
        return word
    if word in WHOLE:
        return WHOLE[word]
    if word in UNCHANGED:
        return word
    w = re.sub("(?<=[aeiouy])y", "Y", "Y" + word[1:] if word[0] == "y" else word)
    head = next((len(p) for p in ("commun", "gener", "arsen") if w.startswith(p)), 0)
    r1 = head or _after(w, 0)
    r2 = _after(w, r1)
    short = lambda x: r1 >= len(x) and bool(_short_end.search(x))
    vowel = lambda x: any(c in "aeiouy" for c in x)

    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and vowel(w[:-2]):
        w = w[:-1]
    if w in AFTER_1A:
        return w

    end = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end in ("eed", "eedly"):
        w = w[: -len(end)] + "ee" if len(w) - len(end) >= r1 else w
    elif end and vowel(w[: -len(end)]):
        w = w[: -len(end)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(DOUBLES):
            w = w[:-1]
        elif short(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"

    end = _longest(w, STEP_2)
    if end and len(w) - len(end) >= r1 and not (end == "ogi" and not w.endswith("logi")) and not (end == "li" and w[-3] not in LI_BEFORE):
        w = w[: -len(end)] + STEP_2[end]
    end = _longest(w, STEP_3)
    if end and len(w) - len(end) >= (r2 if end == "ative" else r1):
        w = w[: -len(end)] + STEP_3[end]
    end = _longest(w, STEP_4)
    if end and len(w) - len(end) >= r2 and not (end == "ion" and w[-4] not in "st"):
        w = w[: -len(end)]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end.search(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


_word = re.compile("[^\\W_]+")
_stops = frozenset(STOP)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("at", T.IntegerType())])))
def terms(texts: pd.Series) -> pd.Series:
    """The stems of a text's words with their places, from 1; stop words have places but no terms."""
    known: dict[str, str] = {}

    def one(text: str | None) -> list[dict]:
        out = []
        for i, w in enumerate(_word.findall((text or "").lower()), 1):
            if w not in _stops:
                if w not in known:
                    known[w] = stem(w)
                out.append({"term": known[w], "at": i})
        return out

    return texts.map(one)
