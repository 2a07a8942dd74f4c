"""Input discovery over a listing of files (path, size), as relational steps.

A listing comes from Spark's binaryFile reader, so any store that Spark reads
will do, and no file's content is read to list it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# File kinds, folders that are never conversations, language folders, speaker names.
AUDIO = ("wav", "mp3", "flac", "m4a", "ogg")
STUDIO = ("wav", "flac")
JUNK = ("output", "outputs", "qa", "review", "reviews", "transcript", "transcripts", "manifests", "annotations", "old", "archive", "__macosx", ".ipynb_checkpoints")
LANGUAGES = {"english": "en", "hindi": "hi", "hinglish": "hinglish", "marwadi": "mwr", "punjabi": "pa"}
SPEAKERS = {1: ("speaker1", "speaker01", "spk1", "spk01", "s1"), 2: ("speaker2", "speaker02", "spk2", "spk02", "s2")}
STEREO_STEMS = ("stereo", "mix", "mixed", "conversation", "call")
STUDIO_KEYS = ("scenario_id", "scenario_name", "topic", "sub_topic", "conversation_style", "language_mix")


def files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = AUDIO) -> DataFrame:
    """rel (the path below root), path, size of all files of these kinds below root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    base = F.regexp_replace(F.lit(root.rstrip("/")), r"^file:/*", "/")
    rel = F.regexp_replace(F.regexp_replace("path", r"^\w+:/+", "/"), F.concat(F.lit("^"), base, F.lit("/")), "")
    return found.withColumn("rel", rel).where(suffix(F.col("path")).isin(*suffixes))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def folders(rel: Column) -> Column:
    parts = F.split(rel, "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def plain_name(name: Column) -> Column:
    """A file or folder name without suffix, spaces, hyphens and underscores, lower-cased."""
    return F.regexp_replace(F.lower(F.regexp_replace(name, r"\.[^.]*$", "")), r"[\s_-]+", "")


def junk(name: Column) -> Column:
    return name.startswith(".") | F.lower(name).isin(*JUNK)


def is_stereo(path: Column, channels: Column) -> Column:
    s = F.lower(stem(path))
    return s.isin(*STEREO_STEMS) | s.contains("stereo") | (F.coalesce(channels, F.lit(1)) >= 2)


def pairs(listing: DataFrame) -> DataFrame:
    """Speaker pairs: session, label_1, path_1, label_2, path_2.

    The root itself if it has two audio files; else each folder with two, or with two folders of one each.
    """
    f = listing.where(suffix(F.col("rel")).isin(*AUDIO)).withColumn("dirs", folders(F.col("rel"))).where(~F.exists("dirs", lambda d: d.startswith(".") | (d == "__MACOSX")))
    f = f.withColumn("depth", F.size("dirs")).where("depth <= 2")
    item = F.struct(F.col("rel"), "path", stem(F.col("rel")).alias("label"))
    per_dir = f.groupBy("depth", "dirs").agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_list(item)), 1, 2).alias("two"))
    direct = per_dir.where("n = 2 and depth < 2").select(F.col("depth"), F.coalesce(F.get("dirs", F.lit(0)), F.lit("")).alias("session"), "two", F.lit(0).alias("how"))
    nested = per_dir.where("n = 1 and depth = 2").select(F.get("dirs", F.lit(0)).alias("session"), F.struct(F.get("dirs", F.lit(1)).alias("label"), F.col("two")[0]["path"].alias("path")).alias("x"))
    nested = nested.groupBy("session").agg(F.array_sort(F.collect_list("x")).alias("two")).where(F.size("two") == 2)
    cols = lambda d: (d["label"], d["path"])
    out = direct.select("depth", "session", "how", *(c.alias(n) for k in (0, 1) for c, n in zip(cols(F.col("two")[k]), (f"label_{k + 1}", f"path_{k + 1}"), strict=True)))
    out = out.union(nested.select(F.lit(1), "session", F.lit(1), *(c for k in (0, 1) for c in cols(F.col("two")[k]))))
    best = F.row_number().over(W.partitionBy("session").orderBy("how"))
    out = out.withColumn("_r", best).where("_r = 1").drop("_r", "how")
    root = out.where("depth = 0").select(F.lit(1).alias("_root"))
    return out.join(root, F.col("depth") > 0, "left_anti").drop("depth")


def input_kind(studio: int, pairs_found: int, stereo: int, mono: int) -> str:
    """What an input folder is taken for, from the numbers found; an error if there is nothing."""
    for name, n in (("studio_speaker_folders", studio), ("speaker_pair", pairs_found), ("stereo", stereo), ("mono", mono)):
        if n:
            return name
    raise ValueError("no audio found in the input folder")


def conversations(listing: DataFrame, languages: dict[str, str] = LANGUAGES) -> DataFrame:
    """Each conversation folder's choice of files: language, code, conversation, path_1, path_2, reason, conversation_id.

    listing: rel (language/conversation/...), path, size, duration_s. Folders and files of junk are passed over. For each
    speaker the best match stands: by file name, then by folder, longest, largest, last by path. Valid
    conversations of a language are numbered in order of the first number in their name.
    """
    f = listing.withColumn("dirs", folders(F.col("rel"))).where(F.size("dirs") >= 2)
    f = f.withColumn("language", F.lower(F.get("dirs", F.lit(0)))).withColumn("conversation", F.get("dirs", F.lit(1))).withColumn("inner", F.slice("dirs", 3, 100)).withColumn("name", F.element_at(F.split("rel", "/"), -1))
    f = f.where(F.col("language").isin(*languages) & ~junk(F.col("conversation")) & ~F.col("name").startswith(".") & ~F.exists("inner", junk))
    wav, other = suffix(F.col("rel")) == "wav", suffix(F.col("rel")).isin("mp3", "flac")

    def best(k: int) -> Column:
        by_name = plain_name(F.col("name")).isin(*SPEAKERS[k])
        by_folder = F.exists("inner", lambda d: plain_name(d).isin(*SPEAKERS[k]))
        rank = F.struct(F.when(by_name, 2).otherwise(1).alias("r"), F.coalesce("duration_s", F.lit(0.0)).alias("d"), F.col("size"), F.col("path"))
        return F.max_by("path", F.when(wav & (by_name | by_folder), rank)).alias(f"path_{k}")

    out = f.groupBy("language", "conversation").agg(best(1), best(2), F.count(F.when(wav, 1)).alias("n_wav"), F.count(F.when(other, 1)).alias("n_other"))
    one, two = F.col("path_1").isNotNull(), F.col("path_2").isNotNull()
    reason = (
        F.when((F.col("n_other") > 0) & (F.col("n_wav") == 0), "unsupported_audio_format")
        .when(one & two & (F.col("path_1") == F.col("path_2")), "ambiguous_speaker_assignment")
        .when(~one & ~two, "missing_speaker_pair")
        .when(~one, "missing_speaker_1")
        .when(~two, "missing_speaker_2")
    )
    out = out.withColumn("reason", reason).where((F.col("n_wav") > 0) | (F.col("n_other") > 0))
    number = F.coalesce(F.expr("try_cast(regexp_extract(conversation, '([0-9]+)', 1) as bigint)"), F.lit(1_000_000_000))
    order = F.row_number().over(W.partitionBy("language").orderBy(F.col("reason").isNotNull(), number, F.lower("conversation"), "conversation"))
    code = F.create_map(*(F.lit(x) for kv in languages.items() for x in kv))[F.col("language")]
    return out.withColumn("code", code).withColumn("conversation_id", F.when(F.col("reason").isNull(), F.format_string("conversation_%04d", order))).drop("n_wav", "n_other")


def conversation_report(found: DataFrame) -> DataFrame:
    """Per language: valid, skipped, and the skipped folders with their reasons, in order."""
    skip = F.when(F.col("reason").isNotNull(), F.struct("conversation", "reason"))
    return found.groupBy("language", "code").agg(F.count(F.when(F.col("reason").isNull(), 1)).alias("valid"), F.count("reason").alias("skipped"), F.array_sort(F.collect_list(skip)).alias("skips"))


def strict_errors(spark: SparkSession, root_exists: bool, report: DataFrame, unknown: list[str]) -> list[str]:
    """What a strict run fails on."""
    if not root_exists:
        return ["input_root_not_found"]
    errors = [f"unknown_language_folder:{name}" for name in sorted(unknown)]
    valid = report.agg(F.sum("valid")).first()[0] or 0
    return errors or ([] if valid else ["no_valid_language_folders_found"])


def canonical_metadata(found: DataFrame, source: Column | None = None) -> DataFrame:
    """The metadata document of each valid conversation, as JSON."""
    doc = F.to_json(F.struct("conversation_id", F.col("code").alias("language"), F.col("language").alias("language_folder"), F.col("conversation").alias("source_folder"), "path_1", "path_2", (F.lit(None).cast("string") if source is None else source).alias("source_metadata")))
    return found.where("reason is null").select("language", "conversation_id", doc.alias("metadata"))


def studio_check(folders_df: DataFrame, allow_missing_metadata: bool = False) -> DataFrame:
    """Studio folders with errors and warnings.

    Needs conversation_id, metadata (JSON or null), n_1 and n_2 (usable files of each speaker), rate_1, rate_2, bits_1, bits_2, ext_1, ext_2.
    """
    m = F.from_json("metadata", "map<string,string>")
    err = lambda c, name: F.when(F.coalesce(c, F.lit(False)), name)
    d = folders_df.withColumn("_m", m)
    given = F.col("metadata").isNotNull()
    errors = F.array_compact(
        F.array(
            err(~given & F.lit(not allow_missing_metadata), "metadata_required"),
            err(given & F.col("_m").isNull(), "metadata_not_an_object"),
            err(F.col("_m")["conversation_id"] != F.col("conversation_id"), "conversation_id_mismatch"),
            *(err(F.col("_m").isNotNull() & ~F.map_contains_key("_m", k), f"missing_field:{k}") for k in STUDIO_KEYS),
            err(F.col("_m").isNotNull() & (F.coalesce(F.col("_m")["scripted"], F.lit("")) != "false"), "scripted_must_be_false"),
            *(err(F.coalesce(F.col(f"n_{k}"), F.lit(0)) != 1, f"speaker_{k}_file") for k in (1, 2)),
            *(err(F.col(f"bits_{k}") < 16, f"speaker_{k}_bit_depth") for k in (1, 2)),
        )
    )
    warnings = F.array_compact(F.array(*(w for k in (1, 2) for w in (err(F.col(f"ext_{k}") == "flac", f"speaker_{k}_flac"), err(F.col(f"rate_{k}") != 48000, f"speaker_{k}_sample_rate")))))
    return d.withColumn("errors", errors).withColumn("warnings", warnings).drop("_m")


def studio_file(listing: DataFrame) -> DataFrame:
    """Of each speaker folder (session, label, path) its file: WAV and FLAC before others; of several, the one named like the folder; n counts the choices."""
    ok = listing.withColumn("_good", suffix(F.col("path")).isin(*STUDIO)).withColumn("_named", stem(F.col("path")) == F.col("label"))
    good = F.max("_good").over(W.partitionBy("session", "label"))
    left = ok.withColumn("_any", good).where(F.col("_good") | ~F.col("_any"))
    out = left.groupBy("session", "label").agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("_named"), F.col("path"))).alias("_named_path"), F.min("path").alias("_first"))
    return out.select("session", "label", F.when(F.col("_n") == 1, F.col("_first")).otherwise(F.col("_named_path")).alias("path"), F.when((F.col("_n") == 1) | F.col("_named_path").isNotNull(), 1).otherwise(F.col("_n")).alias("n"))


def studio_folders(listing: DataFrame) -> DataFrame:
    """Folders that hold a studio conversation, of listed paths relative to the root (rel): the root itself (".") if it has speaker folders, else its children named conversation_*, in order."""
    parts = F.split("rel", "/")
    own = listing.where((F.size(parts) > 1) & parts[0].isin("speaker_1", "speaker_2")).select(F.lit(".").alias("folder")).distinct()
    below = listing.where((F.size(parts) > 1) & parts[0].startswith("conversation_")).select(parts[0].alias("folder")).distinct()
    return below if own.isEmpty() else own


def premium_settings(spark: SparkSession, path: str | None) -> dict:
    """The settings in a JSON file, which must hold one object; none without a path."""
    if not path:
        return {}
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(found, dict):
        raise ValueError("premium settings must be an object")
    return found


def studio_pairs(channels: DataFrame, metadata: DataFrame, checks: DataFrame) -> DataFrame:
    """Channels of studio conversations with recording_type and, by conversation_id, their metadata, errors and warnings."""
    context = checks.select(F.col("conversation_id").alias("session_id"), "errors", "warnings")
    given = metadata.select(F.col("conversation_id").alias("session_id"), "metadata")
    return channels.withColumn("recording_type", F.lit("studio_pair")).join(given, "session_id", "left").join(context, "session_id", "left")
