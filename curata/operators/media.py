"""Media references: cleaning, file names, resolution against listings of files and archive members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.fields import present
from curata.functions.identity import safe_part
from curata.functions.text import is_remote_ref

#: First bytes of image formats, in hex, and the suffix of each.
MAGIC = {"89504E47": ".png", "FFD8FF": ".jpg", "47494638": ".gif", "424D": ".bmp", "52494646": ".webp", "49492A00": ".tif", "4D4D002A": ".tif"}


def clean_ref(ref: Column) -> Column:
    """A URL as a placeholder, an absolute path as its last part, else with forward slashes."""
    slashed = F.replace(ref, F.lit("\\"), F.lit("/"))
    return F.when(is_remote_ref(ref), "<remote-media>").when(slashed.startswith("/"), F.regexp_extract(slashed, r"([^/]*)/*$", 1)).otherwise(slashed)


def safe_member(ref: Column) -> Column:
    """A member name without dots and slashes in front; null if it is empty, absolute or climbs."""
    bare = F.regexp_replace(F.trim(ref), r"^[./]+", "")
    return F.when((bare != "") & ~F.rlike(bare, F.lit(r"(?:^|/)\.{1,2}(?:/|$)")), bare)


def file_name(source: Column, label: Column, suffix: Column) -> Column:
    """<16 hex digits of the source's hash>-<label>.<suffix>."""
    return F.concat(F.substring(F.sha2(source, 256), 1, 16), F.lit("-"), F.substring(safe_part(label, "media"), 1, 48), F.lit("."), F.coalesce(present(F.lower(suffix)), F.lit("bin")))


def image_suffix(path: Column, payload: Column) -> Column:
    """The path's suffix, else what the first bytes say, else .bin."""
    named = present(F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1)))
    head = F.hex(F.substring(payload, 1, 8))
    sniffed = F.coalesce(*(F.when(head.startswith(m), s) for m, s in MAGIC.items()))
    return F.coalesce(named, sniffed, F.lit(".bin"))


def resolve(refs: DataFrame, files: DataFrame, members: DataFrame) -> DataFrame:
    """refs (id, pos, ref) with found: the first file by root_ord of files (path, root_ord), else the first archive by
    archive_ord of members (member, archive, archive_ord); an archive named after the ref's first part comes first."""
    direct = files.groupBy(F.col("path").alias("ref")).agg(F.min_by("path", "root_ord").alias("file"))
    parts = refs.select("ref").distinct().join(members.withColumnRenamed("member", "ref"), "ref")
    named = F.col("archive") == F.concat(F.substring_index("ref", "/", 1), F.lit(".zip"))
    w = Window.partitionBy("ref").orderBy(F.when(named, 0).otherwise(1), "archive_ord", "archive")
    packed = parts.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("ref", "archive")
    joined = refs.join(direct, "ref", "left").join(packed, "ref", "left")
    found = F.coalesce("file", F.when(F.col("archive").isNotNull(), F.concat("archive", F.lit("!"), "ref")))
    return joined.select("id", "pos", "ref", found.alias("found"))


def package(resolved: DataFrame) -> DataFrame:
    """id, media_files (found, by position), missing (refs, by position), n_refs."""
    ordered = lambda c, keep: F.transform(F.array_sort(F.filter(F.collect_list(F.struct("pos", F.col(c).alias("v"), F.col("found").isNotNull().alias("ok"))), keep)), lambda x: x["v"])
    return resolved.groupBy("id").agg(ordered("found", lambda x: x["ok"]).alias("media_files"), ordered("ref", lambda x: ~x["ok"]).alias("missing"), F.count("*").alias("n_refs"))
