"""Sharding by extendible hashing: a directory indexed by hash-prefix bits.

A row's hash is 60 bits of the MD5 of its key. A bucket holds the rows that share a prefix; a bucket over the byte
limit, and only such a bucket, splits on one more bit. The directory is built from a histogram of byte sums by
prefix, so no row moves until the directory is known: round by round, the prefixes of oversized buckets are summed
one batch of bits deeper, from those buckets' rows alone. Only hashes and sizes are read for that.

What no bit can split (one key's rows beyond the limit, a row larger than the limit) goes to overflow pages, packed
greedily within the partitions of a range partitioning by (hash, size), each page within the limit; a row larger than
the limit has a page of its own. A null key hashes as the empty text, a null payload has 0 bytes. Repeated rows share
a bucket. An empty table has no shards. A text of any length is one row. Columns of the input with the name of a
result, in any case of letters, are replaced; others are handed on, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.common import fresh, mapped, others, quoted, small_batches, written

HASH_BITS = 60


def key_hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def prefix(h: Column, bits: Column | int) -> Column:
    n = F.lit(bits) if isinstance(bits, int) else bits
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - n).cast("int"))


def directory(sized: DataFrame, limit: int, first_bits: int = 0, step: int = 6) -> tuple[DataFrame, DataFrame]:
    """(shards, rest) of rows (h, bytes): shards has depth, prefix, shard_bytes, shard_docs; rest has the whole hashes
    whose rows exceed the limit with all bits used."""
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    top = min(HASH_BITS, first_bits + max(step, math.ceil(math.log2(max(2, total / limit))) + 3))
    shards, low, live = None, first_bits, sized
    while True:
        cells = live.groupBy(prefix(F.col("h"), top).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        # every bucket on the way from `low` to `top` bits, summed from the cells below it
        levels = cells.select(F.explode(F.sequence(F.lit(low), F.lit(top))).alias("depth"), "cell", "bytes", "docs")
        sums = levels.groupBy("depth", F.call_function("shiftright", F.col("cell"), (F.lit(top) - F.col("depth")).cast("int")).alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        sums = written(sums, "shard-directory")
        over = sums.where(F.col("shard_bytes") > limit)
        parent = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        fits = sums.where(F.col("shard_bytes") <= limit)
        split = fits.join(parent, (fits["depth"] == parent["depth"]) & (F.call_function("shiftright", fits["prefix"], F.lit(1)) == parent["above"]), "left_semi")
        # at the first level there is no parent; later, `low` is one bit below a bucket that is known to be oversized
        found = split.unionByName(fits.where(F.col("depth") == low))
        shards = found if shards is None else shards.unionByName(found)
        deepest = over.where(F.col("depth") == top).select("prefix")
        if deepest.isEmpty():
            return shards, deepest.select(F.col("prefix").alias("h"))
        if top == HASH_BITS:
            return shards, deepest.select(F.col("prefix").alias("h"))
        live = live.withColumn("_p", prefix(F.col("h"), top)).join(deepest.withColumnRenamed("prefix", "_p"), "_p", "left_semi").drop("_p")
        low, top = top + 1, min(HASH_BITS, top + step)


def assign(docs: DataFrame, limit: int, key: str = "doc_id", payload: str = "text", first_bits: int = 0) -> DataFrame:
    """All columns of docs, plus shard (string), depth, shard_bytes, shard_docs (bigint).

    A shard is named by the bits of its prefix, an overflow page by `over-` and its place.
    """
    spark = docs.sparkSession
    results = ["shard", "depth", "shard_bytes", "shard_docs"]
    kept = others(docs.columns, results)
    names = [quoted(c) for c in kept]
    h, size, at, part, page = fresh([*kept, *results, "prefix"], "h", "bytes", "at", "part", "page")
    rows = docs.select(*names, key_hash(F.col(quoted(key))).alias(h), F.coalesce(F.octet_length(F.col(quoted(payload))), F.lit(0)).cast("bigint").alias(size))
    fits = rows.where(F.col(size) <= limit)
    shards, rest = directory(fits.select(F.col(h).alias("h"), F.col(size).alias("bytes")), limit, first_bits)
    shards, rest = written(shards, "shards"), written(rest, "shards-rest")
    depths = [r["depth"] for r in shards.select("depth").distinct().orderBy("depth").collect()]  # 60 at most
    # a row lies in the one shard whose prefix its hash has: one candidate for each depth that occurs
    places = F.array(*(F.struct(F.lit(d).alias("depth"), prefix(F.col(h), d).alias("prefix")) for d in depths)) if depths else F.array().cast("array<struct<depth:int,prefix:bigint>>")
    hashes = fits.select(h).distinct()
    found = hashes.withColumn(at, F.explode(places)).join(shards, (F.col(f"{at}.depth") == F.col("depth")) & (F.col(f"{at}.prefix") == F.col("prefix")))
    named = found.select(h, F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth").cast("int"), F.lit("0"))).alias("shard"), F.col("depth").cast("bigint").alias("depth"), "shard_bytes", "shard_docs")
    dealt = fits.join(named, h).select(*names, *results)
    if rest.isEmpty() and rows.where(F.col(size) > limit).isEmpty():
        return dealt
    small_batches(spark)
    over = rows.where(F.col(size) > limit).unionByName(fits.join(rest.withColumnRenamed("h", h), h, "left_semi").select(*names, h, size))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        for b in batches:
            out = []
            for n in b.column(len(kept) + 1).to_pylist():
                if held and held + n > limit:
                    number, held = number + 1, 0
                held += n
                out.append(number)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*kept, h, size, part, page])

    schema = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in over.schema), f"{part} int", f"{page} bigint"])
    ordered = over.repartitionByRange(F.col(h), F.col(size), F.rand(7)).sortWithinPartitions(h, size).withColumn(part, F.spark_partition_id())
    packed = written(mapped(ordered, pages, schema), "shard-pages")
    full = packed.groupBy(part, page).agg(F.sum(size).alias("shard_bytes"), F.count("*").alias("shard_docs"))
    paged = packed.join(full, [part, page]).select(*names, F.format_string("over-%d-%d", part, page).alias("shard"), F.lit(HASH_BITS).cast("bigint").alias("depth"), "shard_bytes", "shard_docs")
    return dealt.unionByName(paged)


def write(dealt: DataFrame, path: str, folder_bits: int = 8) -> None:
    """Parquet files with whole shards in order, in a folder for each of 2 ** folder_bits hashes of a shard's name.

    Shards are many and small, so a file holds several; a range of names is one task's, which shards of bounded size
    keep even, and a reader finds a shard by its folder and the files' statistics."""
    (folder,) = fresh(dealt.columns, "folder")
    placed = dealt.withColumn(folder, F.pmod(F.xxhash64("shard"), F.lit(1 << folder_bits)).cast("int"))
    placed.repartitionByRange(folder, "shard").sortWithinPartitions(folder, "shard").write.partitionBy(folder).parquet(path)
