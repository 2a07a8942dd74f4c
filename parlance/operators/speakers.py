"""Speaker and conversation profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicons as lex
from ..functions import text as T
from .interaction import speaking_time


def _pair(v: str, c: float) -> Column:
    return F.struct(F.lit(v).alias("value"), F.lit(c).alias("confidence"))


def speaking_style(wpm: Column, pause_rate: Column, fillers: Column) -> Column:
    """Struct value, confidence, by ordered rules."""
    return (
        F.when(wpm == 0, _pair("silent", 0.9))
        .when(fillers > 0.12, _pair("hesitant", 0.80))
        .when(fillers > 0.08, _pair("hesitant", 0.65))
        .when((wpm < 80) & (pause_rate > 0.40), _pair("deliberate", 0.75))
        .when((wpm < 90) & (pause_rate > 0.35), _pair("deliberate", 0.60))
        .when(wpm > 190, _pair("rapid", 0.80))
        .when(wpm > 170, _pair("rapid", 0.65))
        .when(pause_rate < 0.08, _pair("fluent", 0.70))
        .when(pause_rate < 0.1, _pair("fluent", 0.60))
        .otherwise(_pair("conversational", 0.55))
    )


def formality(fillers: Column, pause_rate: Column) -> Column:
    return F.when(fillers > 0.08, _pair("informal", 0.55)).when(pause_rate > 0.35, _pair("deliberate_or_formal", 0.45)).otherwise(_pair("unknown", 0.30))


def accent(language: Column, scripts: Column) -> Column:
    indic = F.arrays_overlap(scripts, F.array(F.lit("Devanagari"), F.lit("Gurmukhi")))
    return F.when(indic, _pair("indian_subcontinent", 0.70)).when(language.isin("hi", "pa", "mwr"), _pair("indian_subcontinent", 0.65)).when(language.endswith("-Latn"), _pair("indian_english_or_romanised_indic", 0.55)).when(language == "en", _pair("unknown", 0.30)).otherwise(_pair("unknown", 0.25))


def pauses(words: DataFrame, pause_ms: int = 400) -> DataFrame:
    """Per session and speaker: gaps between neighbouring words, and those longer than pause_ms."""
    w = W.partitionBy("session_id", "speaker").orderBy("ws_ms", "seg_idx", "word_idx")
    gap = words.select("session_id", "speaker", F.greatest(F.lit(0), F.lead("ws_ms").over(w) - F.col("we_ms")).alias("g"), F.lead("ws_ms").over(w).isNotNull().alias("has"))
    return gap.groupBy("session_id", "speaker").agg(F.count(F.when(F.col("has"), 1)).alias("gaps"), F.count(F.when(F.col("has") & (F.col("g") > pause_ms), 1)).alias("pauses"))


def profile(words: DataFrame, turns: DataFrame, audio_ms: DataFrame | None = None, fillers: tuple[str, ...] = lex.FILLERS) -> DataFrame:
    """One row per session and speaker of the words or the turns: times, rates, style, formality.

    audio_ms: session_id, audio_ms, for the share of the recording.
    """
    bare = F.regexp_replace(F.lower("word"), r"^['.,!?]+|['.,!?]+$", "")
    spoken = words.groupBy("session_id", "speaker").agg(F.count(F.lit(1)).alias("word_count"), F.count(F.when(bare.isin(*fillers), 1)).alias("filler_count"))
    joined = spoken.join(pauses(words), ["session_id", "speaker"]).join(speaking_time(turns), ["session_id", "speaker"], "full")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = joined.select("session_id", "speaker", *(n(c) for c in ("word_count", "filler_count", "gaps", "pauses", "speaking_ms", "n_turns")))
    wpm = F.when(F.col("speaking_ms") > 0, F.col("word_count") * 60000.0 / F.col("speaking_ms")).otherwise(0.0)
    out = out.withColumns({"wpm": wpm, "pause_rate": F.col("pauses") / F.greatest("gaps", F.lit(1)), "pauses_per_min": F.col("pauses") * 60000.0 / F.greatest("speaking_ms", F.lit(1)), "filler_ratio": F.col("filler_count") / F.greatest("word_count", F.lit(1))})
    if audio_ms is not None:
        out = out.join(audio_ms, "session_id", "left").withColumn("speech_ratio", F.when(F.col("audio_ms") > 0, F.col("speaking_ms") / F.col("audio_ms"))).drop("audio_ms")
    style, form = speaking_style(F.col("wpm"), F.col("pause_rate"), F.col("filler_ratio")), formality(F.col("filler_ratio"), F.col("pause_rate"))
    return out.withColumns({"speaking_style": style["value"], "style_confidence": style["confidence"], "formality": form["value"]})


# What words stand for an intent or a domain, as regular expressions within word edges.
INTENTS = (
    ("greeting", "hi|hello|hey|namaste|namaskar|sat sri akaal|kem cho"),
    ("farewell", "bye|goodbye|alvida|phir milenge|see you"),
    ("question", "what|when|where|why|how|kya|kab|kahan|kyun|kaise"),
    ("complaint", "complain|issue|problem|dikkat|pareshan|galat"),
    ("request", "please|kripya|kindly|could you|can you|mujhe chahiye"),
    ("confirmation", "ok|okay|sure|theek|thik|accha|haan|yes"),
    ("negation", "no|nahi|nahin|nope|bilkul nahi"),
    ("support_inquiry", "support|help|madad|sahayata|assist"),
    ("transaction", "buy|purchase|order|payment|kharid|paisa|price|kitna"),
)
DOMAINS = (
    ("customer_support", "support|help|issue|complaint|ticket|refund|madad|sahayata"),
    ("sales", "buy|purchase|order|pricing|quote|demo|kharid|kitna"),
    ("onboarding", "onboarding|setup|sign up|signup|register|login|account setup"),
    ("healthcare", "doctor|clinic|hospital|medicine|appointment|symptom|health"),
    ("education", "student|teacher|class|course|lesson|school|college|exam"),
    ("finance", "bank|loan|emi|credit|debit|invoice|payment|balance|policy"),
    ("travel", "flight|hotel|booking|travel|trip|train|bus|cab|ticket"),
)
EDGE, WORD = r"[^\p{L}\p{N}_]", r"[\p{L}\p{N}_]"


def _matches(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    def found(low: Column) -> Column:
        # A place whose letter begins no word of the rule fails at once.
        first = lambda words: "".join(sorted({w[0] for w in words.split("|")}))
        hit = lambda name, words: low.rlike(rf"(?=[{first(words)}])(?<!{WORD})(?:{words})(?!{WORD})") | (low.contains("?") if name == "question" else F.lit(False))
        return F.array_compact(F.array(*(F.when(hit(n, w), F.lit(n)) for n, w in rules)))

    return T.once(F.lower(F.coalesce(text, F.lit(""))), found)


def intents(text: Column) -> Column:
    return T.once(_matches(text, INTENTS), lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("informational"))))


def domain(text: Column, has_keywords: Column) -> Column:
    """Struct value, confidence. Each rule is tried once on a text, intents only where no domain is named."""
    named = lambda found: F.struct(F.get(found, F.lit(0)).alias("value"), F.lit(0.68).alias("confidence"))
    meant = T.once(
        intents(text),
        lambda what: F.when(F.arrays_overlap(what, F.array(F.lit("support_inquiry"), F.lit("complaint"))), _pair("customer_support", 0.58))
        .when(F.array_contains(what, "transaction"), _pair("sales", 0.56))
        .when(has_keywords, _pair("casual", 0.42))
        .otherwise(_pair("unknown", 0.2)),
    )
    return T.once(_matches(text, DOMAINS), lambda found: F.when(F.size(found) >= 2, _pair("mixed", 0.55)).when(F.size(found) == 1, named(found)).otherwise(meant))


def keywords(texts: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The most frequent words of each key's texts: key, keyword, n, rank. Of equals the first seen; no stop words, numbers or words under three letters.

    texts: key, idx (order of texts), text.
    """
    each = texts.select(key, "idx", F.posexplode(T.tokens(F.col("text"))).alias("pos", "keyword"))
    each = each.where((F.length("keyword") >= 3) & ~F.col("keyword").isin(*lex.STOPWORDS) & ~F.col("keyword").rlike(r"^\p{N}+$"))
    counts = each.groupBy(key, "keyword").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("idx", "pos")).alias("first"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("n"), "first"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top).select(key, "keyword", "n", "rank")


def tfidf_keywords(texts: DataFrame, key: str, top: int = 10) -> DataFrame:
    """Words by the sum of their TF-IDF weights over a key's texts (smooth idf, each text scaled to length 1): key, keyword, weight, rank."""
    each = texts.select(key, "idx", F.explode(T.tokens(F.col("text"))).alias("keyword"))
    each = each.where((F.length("keyword") >= 2) & ~F.col("keyword").isin(*lex.STOPWORDS))
    tf = each.groupBy(key, "idx", "keyword").agg(F.count(F.lit(1)).alias("tf"))
    n = texts.groupBy(key).agg(F.countDistinct("idx").alias("docs"))
    df = tf.groupBy(key, "keyword").agg(F.count(F.lit(1)).alias("df"))
    w = tf.join(df, [key, "keyword"]).join(n, key).withColumn("x", F.col("tf") * (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1))
    unit = F.sqrt(F.sum(F.col("x") * F.col("x")).over(W.partitionBy(key, "idx")))
    total = w.withColumn("x", F.col("x") / unit).where(~F.col("keyword").rlike(r"^\p{N}+$")).groupBy(key, "keyword").agg(F.sum("x").alias("weight"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("weight"), "keyword"))
    return total.withColumn("rank", rank).where(F.col("rank") <= top)


def conversation_quality(segments: DataFrame) -> DataFrame:
    """Per session, of segments with text: mean, median and time-weighted quality, shares of low and high, number."""
    s = segments.where(F.length(F.trim("text")) > 0).withColumn("d", F.greatest(F.lit(0), F.col("e_ms") - F.col("s_ms")))
    total = F.sum("d")
    q = F.col("quality_score")
    return s.groupBy("session_id").agg(
        F.avg(q).alias("mean_quality"),
        F.median(q).alias("median_quality"),
        (F.sum(q * F.col("d")) / F.when(total == 0, 1).otherwise(total)).alias("weighted_quality"),
        F.avg(F.when(q < 0.35, 1.0).otherwise(0.0)).alias("low_ratio"),
        F.avg(F.when(q >= 0.7, 1.0).otherwise(0.0)).alias("high_ratio"),
        F.count(F.lit(1)).alias("segment_count"),
    )


def conversation_profile(turns: DataFrame) -> DataFrame:
    """Per session: turn_count, speaker_count, mean turn length, total speech."""
    d = F.greatest(F.lit(0), F.col("e_ms") - F.col("s_ms"))
    return turns.groupBy("session_id").agg(F.count(F.lit(1)).alias("turn_count"), F.countDistinct("speaker").alias("speaker_count"), F.avg(d).alias("mean_turn_ms"), F.sum(d).alias("speech_ms"))
