"""op11: every document's bytes, stored in an ISO media container and read back by its sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import iso_media
from curata.llm.common import table


def op11_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # data takes the name of a result, so that it isn't handed on
    packed = iso_media.packed(docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), F.col("text").alias("media")), "media")
    found = iso_media.probed(packed)
    track = F.get("tracks", 0)
    payload = iso_media.stored_bytes(F.col("media"), track["chunks"])
    keys = track["keyframes"]
    shown = F.concat_ws(
        ";", F.concat(F.lit("codec="), track["codec"]), F.concat(F.lit("duration="), track["duration"], F.lit("/"), track["timescale"]), F.concat(F.lit("samples="), track["samples"]), F.concat(F.lit("keyframes="), F.size(keys)),
        F.concat(F.lit("ranges="), F.sha2(F.concat_ws(",", F.transform(keys, lambda r: F.concat(r["offset"].cast("string"), F.lit("+"), r["size"].cast("string")))), 256)),
    )
    # a list of one: the payload is cut out once, for all that is made of it
    read = found.select("doc_id", "n_bytes", "media", shown.alias("feature"), F.explode(F.array(payload)).alias("payload"))
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -iso_media.FRAME, iso_media.FRAME)).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )


QUERIES = {"op11_media_columns": op11_media_columns}
#: SQL can't walk boxes.
SQL: dict[str, str] = {}
