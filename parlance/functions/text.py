"""Text functions as Column builders; all stay in the JVM but nfc()."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types

TOKEN = r"[\p{L}\p{N}_']+"
SPACES = r"[\s\p{Z}]+"
#: Scripts that are told apart, in alphabetical order.
SCRIPTS = ("Bengali", "Devanagari", "Gurmukhi", "Latin", "Tamil", "Telugu")
DIGITS = ("०१२३४५६७८९੦੧੨੩੪੫੬੭੮੯", "01234567890123456789")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, however often f names it: a column named in several branches is computed in each."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits, underscores and apostrophes; combining marks part words."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def normalised(text: Column) -> Column:
    """Lower case without punctuation and symbols, spaces collapsed; marks stay. Compose first with nfc() where texts may be decomposed."""
    return collapse(F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]", ""))


@F.pandas_udf(types.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition, which Spark has no function for."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def for_wer(text: Column) -> Column:
    """Lower case, everything but letters, digits, underscores and spaces becomes a space, spaces collapsed."""
    return collapse(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "))


def for_consensus(text: Column) -> Column:
    """for_wer with Devanagari and Gurmukhi digits as ASCII."""
    return for_wer(F.translate(text, *DIGITS))


def split_words(normal: Column) -> Column:
    return F.filter(F.split(normal, " "), lambda w: w != "")


def _has(text: Column, script: str) -> Column:
    return text.rlike(rf"\p{{Is{script}}}") if script != "Latin" else text.rlike(r"\p{IsLatin}")


def scripts(text: Column) -> Column:
    """Names of the scripts that letters of the text come from, sorted."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\p{P}]", "")
    return F.array_compact(F.array(*(F.when(_has(letters, s), F.lit(s)) for s in SCRIPTS)))


def script_tag(text: Column) -> Column:
    """Deva, Guru, Latn, mixed or unknown."""
    found = F.array_compact(F.array(*(F.when(_has(text, s), F.lit(t)) for s, t in (("Devanagari", "Deva"), ("Gurmukhi", "Guru"), ("Latin", "Latn")))))
    return once(found, lambda f: F.when(F.size(f) > 1, "mixed").otherwise(F.coalesce(F.get(f, F.lit(0)), F.lit("unknown"))))


def major_script(text: Column) -> Column:
    """The script of most letters; of equals Deva, then Guru, then Latn."""
    count = lambda s: F.length(F.regexp_replace(text, rf"[^\p{{Is{s}}}]", ""))
    counts = F.struct(count("Devanagari").alias("d"), count("Gurmukhi").alias("g"), count("Latin").alias("n"))
    return once(counts, lambda c: F.when(F.greatest(c["d"], c["g"], c["n"]) == 0, "unknown").when((c["d"] >= c["g"]) & (c["d"] >= c["n"]), "Deva").when(c["g"] >= c["n"], "Guru").otherwise("Latn"))


def ratio_of(words: Column, table: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*table)))


@F.pandas_udf(types.IntegerType())
def word_edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Levenshtein distance of two word arrays; levenshtein() is for characters, and a fold over arrays copies a row a word."""
    return pd.Series([_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def _distance(a: np.ndarray, b: np.ndarray) -> int:
    """A row of the table at a time: insertions within a row are a running minimum of cost less place."""
    if not len(a) or not len(b):
        return len(a) + len(b)
    codes = {w: k for k, w in enumerate({*a, *b})}
    other = np.array([codes[w] for w in b])
    place = np.arange(len(b) + 1)
    row = place.copy()
    for i, w in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[:-1] + (other != codes[w]), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - place) + place
    return int(row[-1])


def error_rate(distance: Column, reference: Column) -> Column:
    """distance / length; with an empty reference 0 if nothing was said, else 1."""
    return F.when(reference == 0, F.when(distance == 0, 0.0).otherwise(1.0)).otherwise(distance / reference)


@F.pandas_udf(types.DoubleType())
def sequence_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two word arrays (two empty ones: 1), which has no built-in."""
    return pd.Series([1.0 if not len(x) and not len(y) else SequenceMatcher(None, list(x), list(y)).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def bag_overlap(a: Column, b: Column) -> Column:
    """Words in common, with their number, against the longer list. For short lists: its time is their product; consensus.bags() joins counts instead."""
    distinct = F.array_distinct(a)
    times = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    shared = F.aggregate(distinct, F.lit(0), lambda s, w: s + F.least(times(a, w), times(b, w)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(shared / F.greatest(F.size(a), F.size(b), F.lit(1)))


def file_name(text: Column) -> Column:
    """A name for files: letters, digits, dot, underscore and hyphen; others become underscores."""
    return F.regexp_replace(F.trim(text), r"[^A-Za-z0-9._-]+", "_")


def ascii_id(text: Column) -> Column:
    """An ASCII identifier for export lines."""
    clean = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9_-]+", "_"), F.lit("_"))
    return F.when(clean == "", "unknown").otherwise(clean)


def bcp47(code: Column, table: dict[str, str]) -> Column:
    """A tag with a hyphen stays, a known code (in this case of letters) becomes its tag, another stays as it is; null is empty."""
    known = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.when(code.contains("-"), code).otherwise(F.coalesce(F.try_element_at(known, code), code, F.lit("")))
