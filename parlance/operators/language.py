"""Language of segments and words, code switching and language reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicons as lex
from ..functions import text as T


def lexicon_probe(words: Column, legacy: bool = False) -> Column:
    """Struct lang, hits, strength: the romanised language most of whose words a token list holds.

    At least two hits and one in twenty; of equals Marwadi, then Punjabi, then Hindi. legacy adds words
    that English, French and Spanish share.
    """
    hindi = (*lex.ROMAN_HINDI, *(lex.LEGACY_COLLISIONS["hi"] if legacy else ()))
    punjabi = (*lex.ROMAN_PUNJABI, *(lex.LEGACY_COLLISIONS["pa"] if legacy else ()))
    counts = F.struct(*(T.ratio_of(words, table).alias(k) for k, table in (("m", lex.ROMAN_MARWADI), ("p", punjabi), ("h", hindi))), F.greatest(F.size(words), F.lit(1)).alias("size"))

    def judge(c: Column) -> Column:
        best = F.greatest(c["m"], c["p"], c["h"])
        lang = F.when(c["m"] == best, "mwr-Latn").when(c["p"] == best, "pa-Latn").otherwise("hi-Latn")
        ratio = best / c["size"]
        found = (best >= 2) & (ratio >= 0.05)
        return F.struct(F.when(found, lang).alias("lang"), best.alias("hits"), F.when(found, F.least(F.lit(1.0), ratio * 4.0)).otherwise(0.0).alias("strength"))

    return T.once(counts, judge)


def marwadi_devanagari(text: Column, words: Column) -> Column:
    """Share of Marwadi markers, six times over, 1 at most; a marker counts wherever the text holds it."""
    hits = sum((F.when(F.contains(text, F.lit(m)), 1).otherwise(0) for m in lex.MARWADI_DEVANAGARI), F.lit(0))
    return F.least(F.lit(1.0), hits * 6.0 / F.greatest(F.size(words), F.lit(1)))


def segment_language(text: Column, ml_lang: Column | None = None, ml_score: Column | None = None, legacy: bool = False) -> Column:
    """Struct lang, confidence: script first, then a trusted classifier, then the lexicon, English last."""
    ml_lang = F.lit(None).cast("string") if ml_lang is None else ml_lang
    ml_score = F.lit(0.0) if ml_score is None else ml_score
    pair = lambda lang, score: F.struct(lang.alias("lang"), score.cast("double").alias("confidence"))
    mwr = T.once(T.tokens(text), lambda w: marwadi_devanagari(text, w))
    deva = T.once(mwr, lambda m: F.when(m >= 0.25, pair(F.lit("mwr"), F.greatest(F.lit(0.7), m))).otherwise(pair(F.lit("hi"), F.lit(0.9))))
    probe = T.once(T.once(T.tokens(text), lambda w: lexicon_probe(w, legacy)), lambda p: F.when(p["strength"] > 0.1, pair(p["lang"], 0.55 + 0.3 * p["strength"])).otherwise(pair(F.lit("en"), F.lit(0.6))))
    return (
        F.when(text.rlike(r"\p{IsDevanagari}"), deva)
        .when(text.rlike(r"\p{IsGurmukhi}"), pair(F.lit("pa"), F.lit(0.9)))
        .when(ml_lang.isNotNull() & (ml_score >= 0.55), pair(ml_lang, ml_score))
        .otherwise(probe)
    )


def word_language(word: Column, segment_lang: Column) -> Column:
    """Struct lang, confidence of one word: script, then Hindi, Punjabi and Marwadi words, then English, else the segment's."""
    pair = lambda lang, score: F.struct(F.lit(lang).alias("lang"), F.lit(score).alias("confidence"))
    clean = F.regexp_replace(F.lower(F.coalesce(word, F.lit(""))), r"[^\p{L}\p{N}']", "")
    fallback = F.struct(F.coalesce(segment_lang, F.lit("und")).alias("lang"), F.lit(0.5).alias("confidence"))

    def judge(t: Column) -> Column:
        listed = F.when(t["w"].isin(*lex.ROMAN_HINDI), pair("hi-Latn", 0.78)).when(t["w"].isin(*lex.ROMAN_PUNJABI), pair("pa-Latn", 0.76)).when(t["w"].isin(*lex.ROMAN_MARWADI), pair("mwr-Latn", 0.76))
        written = F.when(t["s"] == "Deva", pair("hi", 0.9)).when(t["s"] == "Guru", pair("pa", 0.9))
        return F.coalesce(written, listed, F.when(t["s"] == "Latn", pair("en", 0.68)), fallback)

    return T.once(T.once(clean, lambda w: F.struct(w.alias("w"), T.script_tag(w).alias("s"))), judge)


def base(lang: Column) -> Column:
    return F.split(lang, "-")[0]


def switch_points(words: DataFrame, word: str = "word", lang: str = "lang") -> DataFrame:
    """Where a segment's language changes from one word to the next: session_id, seg_idx, word_idx, from_lang, to_lang, switch_type.

    words: session_id, seg_idx, word_idx, the word and its language.
    """
    w = W.partitionBy("session_id", "seg_idx").orderBy("word_idx")
    n = F.count(F.lit(1)).over(W.partitionBy("session_id", "seg_idx"))
    seen = words.select("session_id", "seg_idx", "word_idx", F.col(lang).alias("to_lang"), F.lag(lang).over(w).alias("from_lang"), F.lead(lang).over(w).alias("next_lang"), F.lag(word).over(w).alias("prev_word"), n.alias("n"))
    tag = (F.col("n") >= 3) & (F.col("from_lang") == F.col("next_lang"))
    kind = (
        F.when(base(F.col("from_lang")) == base(F.col("to_lang")), "intra_word")
        .when(tag, "tag")
        .when(F.col("prev_word").rlike(r"[.?!]\s*$"), "inter_sentential")
        .otherwise("intra_sentential")
    )
    return seen.where(F.col("from_lang") != F.col("to_lang")).select("session_id", "seg_idx", "word_idx", "from_lang", "to_lang", kind.alias("switch_type"))


def matrix_language(words: DataFrame, lang: str = "lang") -> DataFrame:
    """Per segment: n_words, matrix_language (most words; of equals the first seen), n_switches, cs_density (switches in a hundred words)."""
    counts = words.groupBy("session_id", "seg_idx", lang).agg(F.count(F.lit(1)).alias("c"), F.min("word_idx").alias("first"))
    matrix = counts.groupBy("session_id", "seg_idx").agg(F.sum("c").alias("n_words"), F.max_by(lang, F.struct("c", -F.col("first"))).alias("matrix_language"))
    w = W.partitionBy("session_id", "seg_idx").orderBy("word_idx")
    change = words.select("session_id", "seg_idx", F.when(F.col(lang) != F.lag(lang).over(w), 1).alias("x")).groupBy("session_id", "seg_idx").agg(F.count("x").alias("n_switches"))
    return matrix.join(change, ["session_id", "seg_idx"]).select("*", (F.col("n_switches") * 100.0 / F.greatest("n_words", F.lit(1))).alias("cs_density"))


def code_switch_density(words: DataFrame, lang: str = "lang") -> DataFrame:
    """Per session: switch points in a hundred words, and segments by matrix language."""
    m = matrix_language(words, lang)
    total = m.groupBy("session_id").agg(F.sum("n_switches").alias("switches"), F.sum("n_words").alias("words"))
    by = m.groupBy("session_id", "matrix_language").agg(F.count(F.lit(1)).alias("c")).groupBy("session_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("matrix_language", "c")))).alias("matrix_languages"))
    return total.join(by, "session_id").select("*", (F.col("switches") * 100.0 / F.greatest("words", F.lit(1))).alias("density"))


def report(segments: DataFrame, key: list[str] = ["session_id"], lang: str = "language") -> DataFrame:
    """Language report per key: dominant language, number of languages, switches and their rate.

    Time is the sum of durations, where a segment without duration counts a second;
    of equals the language seen first. multilingual means two languages or more.
    """
    length = F.when(F.col("e_ms") > F.col("s_ms"), F.col("e_ms") - F.col("s_ms")).otherwise(1000)
    times = segments.groupBy(*key, lang).agg(F.sum(length).alias("t"), F.min("idx").alias("first"))
    top = times.groupBy(*key).agg(F.max_by(lang, F.struct("t", -F.col("first"))).alias("dominant_language"), F.count(F.lit(1)).alias("n_languages"))
    w = W.partitionBy(*key).orderBy("s_ms", "idx")
    change = segments.select(*key, "s_ms", "e_ms", F.when(F.col(lang) != F.lag(lang).over(w), 1).alias("x"))
    rates = change.groupBy(*key).agg(F.count("x").alias("switch_count"), (F.max("e_ms") - F.min("s_ms")).alias("span_ms"))
    per_min = F.when(F.col("span_ms") > 0, F.col("switch_count") * 60000.0 / F.col("span_ms")).otherwise(0.0)
    return top.join(rates, key).select(*key, "dominant_language", "n_languages", (F.col("n_languages") >= 2).alias("multilingual"), "switch_count", per_min.alias("switching_frequency"), F.least(F.lit(1.0), per_min / 10.0).alias("switching_score"))


def code_switch_report(segments: DataFrame, lang: str = "language") -> DataFrame:
    """Per session: switch_count, distinct patterns in order (a→b), switching_frequency per minute."""
    w = W.partitionBy("session_id").orderBy("s_ms", "e_ms", "idx")
    seen = segments.select("session_id", "s_ms", "e_ms", F.row_number().over(w).alias("o"), F.lag(lang).over(w).alias("a"), F.col(lang).alias("b"))
    change = F.col("a") != F.col("b")
    out = seen.groupBy("session_id").agg(F.count(F.when(change, 1)).alias("switch_count"), F.array_sort(F.collect_list(F.when(change, F.struct("o", F.concat("a", F.lit("→"), "b").alias("p"))))).alias("ps"), (F.max("e_ms") - F.min("s_ms")).alias("span_ms"))
    rate = F.when(F.col("span_ms") > 0, F.col("switch_count") * 60000.0 / F.col("span_ms")).otherwise(0.0)
    return out.select("session_id", "switch_count", F.array_distinct(F.transform("ps", lambda x: x["p"])).alias("patterns"), rate.alias("switching_frequency"))


def distribution(segments: DataFrame, lang: str = "language") -> DataFrame:
    """Per session: segments by BCP-47 tag, as a map in order of tags."""
    tag = T.bcp47(F.col(lang), lex.BCP47)
    counts = segments.groupBy("session_id", tag.alias("tag")).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy("session_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "c")))).alias("distribution"))


#: Languages whose last word gets a full stop when it has no punctuation.
PUNCTUATED = ("en", "pa", "mr", "hi-Latn", "mwr-Latn")


def punctuate(words: DataFrame, segments: DataFrame, enabled: bool = True) -> DataFrame:
    """words (session_id, seg_idx, word_idx, word) with text and trailing_punct parted, and punct_skipped of their segment.

    A word of punctuation alone keeps its text. Hindi and Devanagari segments are skipped. The last word of a
    segment in a supported language gets a full stop if it has no punctuation.
    """
    return punctuated(words, segments, enabled).select("session_id", "seg_idx", "word_idx", "text", "trailing_punct", "punct_skipped")


def punctuated(words: DataFrame, segments: DataFrame, enabled: bool = True) -> DataFrame:
    """punctuate() with all columns of words (no text, trailing_punct or punct_skipped among them), and segment_language.

    A segment and its words meet in one sorted union, not in a join: where both are dealt by session_id already,
    words don't travel again.
    """
    trail = F.regexp_extract("word", r"(\p{P}+)$", 1)
    bare = F.regexp_replace("word", r"\p{P}+$", "")
    about = F.struct(F.col("language").alias("lang"), T.major_script(F.coalesce("text", F.lit(""))).alias("script"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in words.schema if f.name not in ("session_id", "seg_idx")]
    seg = segments.select("session_id", F.col("idx").cast(words.schema["seg_idx"].dataType).alias("seg_idx"), *none, about.alias("_about"))
    rest = [c for c in words.columns if c not in ("session_id", "seg_idx")]
    both = words.select("session_id", "seg_idx", *rest, F.lit(None).cast(seg.schema["_about"].dataType).alias("_about")).union(seg).where("session_id is not null and seg_idx is not null")
    w = W.partitionBy("session_id", "seg_idx").orderBy(F.col("_about").isNull(), "word_idx")
    seen = both.withColumn("_said", F.col("_about").isNull()).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    seen = seen.withColumn("_seg", F.last("_about", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).where("_said and _seg is not null")
    lang = F.col("_seg.lang")
    skipped = F.when(F.lit(not enabled), "disabled").when((lang == "hi") | (F.col("_seg.script") == "Deva"), "hindi_model_unavailable").when(~F.coalesce(lang, F.lit("")).isin(*PUNCTUATED), "unsupported_language")
    out = seen.withColumn("punct_skipped", skipped)
    stop = F.when((trail == "") & F.col("_last") & F.col("punct_skipped").isNull(), ".").otherwise(trail)
    return out.select(*words.columns, F.when(bare == "", F.col("word")).otherwise(bare).alias("text"), stop.alias("trailing_punct"), "punct_skipped", lang.alias("segment_language"))
