"""English stems (the published Porter2 rules) and stop words, over token arrays."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words, exceptions, and the endings of each step with what takes their place.
STOP_WORDS = frozenset(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs "
    "themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t "
    "can will just don should now".split()
)
_EXCEPTIONS = dict(
    zip(
        "skis skies dying lying tying idly gently ugly early only singly sky news howe atlas cosmos bias andes".split(),
        "ski sky die lie tie idl gentl ugli earli onli singl sky news howe atlas cosmos bias andes".split(),
        strict=True,
    )
)
_STAY = frozenset("inning outing canning herring earring proceed exceed succeed".split())
_STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate",
    "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive",
    "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
_STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
_STEP4 = {e: "" for e in "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()}

_REGION = re.compile(r"[aeiouy][^aeiouy](.*)")
_SHORT = re.compile(r"(?:.*[^aeiouy][aeiouy][^aeiouywxY]|[aeiouy][^aeiouy])")


def _after(word: str) -> str:
    m = _REGION.search(word)
    return m.group(1) if m else ""


def _longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a lower-case English word."""
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    if len(word) < 3:
        return word
    w = re.sub(r"(?:^|(?<=[aeiouy]))y", "Y", word.removeprefix("'"))
    head = next((p for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = len(w) - len(w[len(head) :] if head else _after(w))
    r2 = len(w) - len(_after(w[r1:]))

    def replaced(w: str, table: dict[str, str], region: int, fits) -> str:
        e = _longest(w, table)
        return w[: len(w) - len(e)] + table[e] if e and len(w) - len(e) >= region and fits(w[: len(w) - len(e)], e) else w

    w = re.sub(r"'(?:s'?)?$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(r"[aeiouy].", w[:-1]):
        w = w[:-1]
    if w in _STAY:
        return w
    e = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if e in ("eed", "eedly"):
        w = w[: len(w) - len(e)] + "ee" if len(w) - len(e) >= r1 else w
    elif e and re.search("[aeiouy]", w[: len(w) - len(e)]):
        w = w[: len(w) - len(e)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif re.search(r"(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$", w):
            w = w[:-1]
        elif r1 >= len(w) and _SHORT.fullmatch(w):
            w += "e"
    w = re.sub(r"(?<=.[^aeiouy])[yY]$", "i", w)
    w = replaced(w, _STEP2, r1, lambda rest, e: (e != "ogi" or rest.endswith("l")) and (e != "li" or rest.endswith(tuple("cdeghkmnrt"))))
    w = replaced(w, _STEP3, r1, lambda rest, e: e != "ative" or len(rest) >= r2)
    w = replaced(w, _STEP4, r2, lambda rest, e: e != "ion" or rest.endswith(("s", "t")))
    if w.endswith("e") and (len(w) > r2 or (len(w) > r1 and not _SHORT.fullmatch(w[:-1]))) or w.endswith("ll") and len(w) > r2:
        w = w[:-1]
    return w.lower()


def english(word: str) -> str:
    """The stem of a word; empty for a stop word, so that places stay."""
    return "" if word in STOP_WORDS else stem(word)


def stems(tokens: Column) -> Column:
    """english() of every token, in Arrow batches; each worker remembers the words it has met."""

    @F.pandas_udf("array<string>")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda ts: None if ts is None else [english(t) for t in ts])

    return run(tokens)
