"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled by seed within their source; the r-th of n rows gets the fractional rank (r - 1 + s) / n.  The shift s of
a source is 1/2 if no other has as many rows; the k sources of one size are shuffled too and shifted by 1/2k, 3/2k and so on,
so that thousands of sources of one row are spread over the shards like the rows of one source.  Sorted by fractional rank, every stretch of the table has the mixture of the whole, so the order is cut into shards whose row counts
differ by one at most (the law ``rows``).  Neither order is taken in one task: ranks within a source are offsets of hash
ranges plus places within a range, and the places in the sorted order are offsets of equal stretches of fractional rank
plus places within a stretch; the offsets themselves are summed in two levels.  Ranges and stretches hold a bounded expected number of rows, whatever the sources' sizes:
the digest is one of id and text, so rows without an id are spread as well.  Sources of one size are numbered by ranges, too.

Defined results: a NULL text has size 1 and checksum 0; NULL sources form one source; repeated rows are dealt like any
others; an empty table gives an empty table; extra columns are ignored, or passed on where named in ``carry``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm import common
from panelforge.llm.common import fresh, identified, key_of, seeded, sums_before, unit_fraction
from panelforge.storage import materialize

SEED = "shards-1"
SHARDS = 8
RANGE_ROWS = 1024


def _shifts(sources: DataFrame, seed: str, range_rows: int) -> DataFrame:
    """``sources`` (``source_key``, ``of``: its rows) with their number among the sources of as many rows, and how many those are."""
    drawn = materialize(sources.withColumn("drawn", seeded(seed, "source", F.col("source_key"))), "shard-sources")
    n_ranges = max(1, math.ceil(drawn.count() / range_rows))
    drawn = drawn.withColumn("part", F.floor(unit_fraction(F.col("drawn")) * F.lit(n_ranges)).cast("long"))
    size = Window.partitionBy("of")
    parts = drawn.groupBy("of", "part").agg(F.count("*").alias("n"))
    parts = parts.select(
        "of", "part",
        F.coalesce(F.sum("n").over(size.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(size).alias("alike"),
    )
    numbered = drawn.withColumn("own", F.row_number().over(Window.partitionBy("of", "part").orderBy("drawn", "source_key")))
    return numbered.join(parts, ["of", "part"]).select("source_key", "of", "alike", (F.col("before") + F.col("own")).alias("number"))


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of each key, written, as they are read twice: one for every ``range_rows`` rows of the input."""
    return materialize(rows.groupBy(*keys).agg(F.count("*").alias("n")), "shard-counts")


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
    range_rows: int = RANGE_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: size, checksum, shard and gapless slot within the shard."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        key_of(source_col).alias("source_key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        seeded(seed, F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.crc32(text)).alias("digest"),
        *carry,
    )
    rows = materialize(rows, "shard-rows")
    total = rows.count()
    n_ranges = max(1, math.ceil(total / range_rows))
    ranged = rows.withColumn("range", F.floor(unit_fraction(F.col("digest")) * F.lit(n_ranges)).cast("long"))

    offsets = sums_before(_counted(ranged, "source_key", "range"), ["source_key"], F.floor(F.col("range") / common.PART_ROWS), ["range"], offset=F.col("n"))
    offsets = materialize(offsets.select("source_key", "range", "offset", F.col("offset_all").alias("of")), "shard-offsets")
    shifts = _shifts(offsets.select("source_key", "of").distinct(), seed, range_rows)
    ties = ["digest", "doc_id", "text_crc32", "size"]
    within = Window.partitionBy("source_key", "range").orderBy(*ties)
    ranked = ranged.withColumn("place", F.row_number().over(within)).join(offsets.drop("of").join(shifts, "source_key"), ["source_key", "range"])
    place = F.col("offset") + F.col("place") - 1
    fraction = (2 * (place * F.col("alike") + F.col("number")) - 1).cast("double") / (2 * F.col("alike") * F.col("of")).cast("double")
    ranked = ranked.withColumn("fraction", fraction).withColumn("stretch", F.floor(F.col("fraction") * F.lit(n_ranges)).cast("long"))
    ranked = materialize(ranked.drop("range", "offset", "of", "place", "alike", "number"), "shard-ranks")

    stretches = sums_before(_counted(ranked, "stretch"), [], F.floor(F.col("stretch") / common.PART_ROWS), ["stretch"], offset=F.col("n"))
    stretches = stretches.select("stretch", "offset")
    inside = Window.partitionBy("stretch").orderBy("fraction", "source_key", *ties)
    dealt = ranked.withColumn("place", F.row_number().over(inside)).join(stretches, "stretch")
    dealt = dealt.withColumn("position", F.col("offset") + F.col("place") - 1)
    dealt = dealt.withColumn("shard", F.expr(f"cast(position * {shards} div {max(1, total)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carry
    )


def sharded_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` with the columns ``shard`` and ``slot`` (underscores before them where ``docs`` has such names)."""
    marked, row = identified(docs)
    narrow = marked.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source"), F.col(row).alias("row"))
    dealt = interleave(narrow, shards, carry=("row",), **settings)
    dealt = dealt.select(F.col("row").alias(row), F.col("shard").alias(fresh(docs, "shard")), F.col("slot").alias(fresh(docs, "slot")))
    return marked.join(dealt, row).drop(row)


def sql(shards: int = SHARDS, seed: str = SEED) -> str:
    """DuckDB text for ``interleave`` over ``documents``; the checksum is worked out byte by byte."""
    return f"""
WITH steps AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS n))),
sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS source_key, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, steps),
rows AS (SELECT *, md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || text_crc32) AS digest FROM sized),
sources AS (SELECT source_key, count(*) AS n_rows FROM rows GROUP BY source_key),
shifts AS (
  SELECT source_key, n_rows, count(*) OVER (PARTITION BY n_rows) AS alike,
    row_number() OVER (PARTITION BY n_rows ORDER BY md5('{seed}:source:' || source_key), source_key) AS number FROM sources),
ranked AS (
  SELECT rows.*, (2 * ((row_number() OVER (PARTITION BY source_key ORDER BY digest, doc_id NULLS FIRST, text_crc32, size) - 1) * alike + number) - 1)::DOUBLE
    / (2 * alike * n_rows)::DOUBLE AS fraction FROM rows JOIN shifts USING (source_key)),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source_key, digest, doc_id NULLS FIRST, text_crc32, size) - 1 AS position, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (position * {shards} // n)::INTEGER AS shard,
  (position - ((position * {shards} // n) * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
