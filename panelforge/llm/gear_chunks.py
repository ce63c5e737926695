"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of every whole text; a chunk ends where the hash has a given pattern, but not before
``MIN_BYTES`` and no later than ``MAX_BYTES``.  Cuts depend on the bytes just before them only, so an insertion moves the
cuts around itself and leaves the others.  Chunks with equal 128-bit digests in several rows are copies; the occurrence with the smallest
id (rows without one come last), then place in the files, then position is their keeper.  Consecutive copied chunks are a run, whatever their keepers: earlier documents may hold parts
of a passage that later ones share whole.  Runs of ``MIN_SPAN_WORDS`` or more are reported, one repeated span for each stretch of one keeper.  A passage loses less than one chunk at either
end, so passages of over 50 words are found, while shared lines of a dozen words are left alone.

Digests are counted by partial aggregation.  The copied ones are written with their keepers and joined to the chunks, which are cut once
more: a bit map of copied digests, sized by their number up to 2**``MAX_BITS`` bits, lets tasks leave out most chunks that have no copy
before they are shuffled (and only those: what the map lets through is joined by the whole digest).  A digest with more than one in
``HOT_SHARE`` of the copied chunks is cut into parts for the join, so a chunk that a third of all documents share is neither gathered
nor one task.  Such digests are fewer than ``HOT_SHARE`` by count and broadcast.  Defined results: NULL and empty texts have no chunks; rows are told apart by their place in the files, so
rows without an id or with the same id are documents like others, and of repeated rows the first keeps; passages that one text
repeats count with ``within``; very long texts are cut whole; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, fresh, identified
from panelforge.storage import materialize

MIN_BYTES = 8
MASK_BITS = 5
MAX_BYTES = 96
MIN_SPAN_WORDS = 20

#: Bits of the map of copied digests: for each digest, and at most (as a power of two).
BITS_PER_DIGEST = 16
MAX_BITS = 27

#: A digest with more than one in so many copied chunks is hot.
HOT_SHARE = 1_000

#: The table of the gear hash, from a rule: one hash per byte value.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 2024) for b in range(256)], np.uint64)

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: the sum over the last 64 bytes of GEAR[b] << age, by doubling."""
    h = GEAR[data]
    for shift in (1, 2, 4, 8, 16, 32):
        if len(h) <= shift:
            break
        h[shift:] += h[:-shift].copy() << np.uint64(shift)
    return h


def cuts(data: np.ndarray, low: int = MIN_BYTES, bits: int = MASK_BITS, high: int = MAX_BYTES) -> list[int]:
    """Ends of the chunks of a text."""
    ends, start, n = [], 0, len(data)
    for mark in (np.nonzero((gear_hashes(data) >> np.uint64(64 - bits)) == 0)[0] + 1).tolist():
        while mark - start > high:
            start += high
            ends.append(start)
        if mark - start >= low:
            start = mark
            ends.append(mark)
    while n - start > high:
        start += high
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_rows(text: bytes) -> tuple[list[bytes], list[int], list[int], list[int]]:
    """Digest, start, length and words begun, for each chunk."""
    data = np.frombuffer(text, np.uint8)
    ends = cuts(data)
    starts = [0, *ends[:-1]]
    white = _WHITE[data]
    begun = ~white
    begun[1:] &= white[:-1]
    words = np.add.reduceat(begun, starts, dtype=np.int64).tolist() if ends else []
    digest = xxhash.xxh3_128_digest
    return [digest(text[a:b]) for a, b in zip(starts, ends, strict=True)], starts, [b - a for a, b in zip(starts, ends, strict=True)], words


#: A chunk's first byte, bytes and words begun in one number, which compresses better and orders by the first byte.
_PLACE = {"start": "place >> 16", "bytes": "CAST(place >> 8 & 255 AS INT)", "words": "CAST(place & 255 AS INT)"}


_OWNER = ["doc_id", "file", "row"]


def _run(batches: Iterator[pa.RecordBatch], marks: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    names = ["hi", "lo", "chunk", "place", *_OWNER]
    shift = None if marks is None else np.uint64(64 - (len(marks) * 8).bit_length() + 1)

    def batch_of(parts: list[list[np.ndarray]], batch: pa.RecordBatch) -> pa.RecordBatch:
        *columns, who = (pa.array(np.concatenate(c)) for c in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([*columns, *(batch.column(c).take(who) for c in _OWNER)], names=names)

    for batch in batches:
        parts: list[list[np.ndarray]] = []
        held = 0
        for number, text in enumerate(batch.column("text").cast(pa.binary())):
            value = text.as_py()
            if not value:
                continue
            digests, starts, sizes, words = chunk_rows(value)
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            n = len(digests)
            place = np.array(starts, np.int64) << 16 | np.array(sizes, np.int64) << 8 | np.array(words, np.int64)
            columns = [pair[:, 0], pair[:, 1], np.arange(n, dtype=np.int64), place, np.full(n, number, np.int64)]
            if marks is not None:
                bit = pair[:, 0].view(np.uint64) >> shift
                kept = np.flatnonzero(marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                columns = [c[kept] for c in columns]
            parts.append(columns)
            held += len(columns[0])
            if held > 100_000:
                yield batch_of(parts, batch)
                parts, held = [], 0
        if parts:
            yield batch_of(parts, batch)


def text_rows(marked: DataFrame, row: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, place in the files and text of every row of ``identified`` documents."""
    return marked.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"{row}.file").alias("file"), F.col(f"{row}.row").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))


def chunks(rows: DataFrame, bits: bytes | None = None) -> DataFrame:
    """Every chunk of every text of ``text_rows``: its digest as two longs, number, place (see ``_PLACE``) and row.

    With ``bits`` only chunks whose bit is set.
    """
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _run(batches, None if bits is None else np.frombuffer(bits, np.uint8))

    return rows.mapInArrow(run, "hi long, lo long, chunk long, place long, doc_id long, file long, row long")


def bit_map(digests: DataFrame, count: int) -> bytes:
    """One bit for the first bits of ``hi`` of each digest, at most 2**(MAX_BITS - 6) words of 64 bits."""
    bits = min(max(10, (count * BITS_PER_DIGEST).bit_length()), MAX_BITS)
    top = F.shiftrightunsigned("hi", 64 - bits)
    cells = digests.select(F.shiftright(top, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(hi >>> {64 - bits} & 63 AS int))").alias("bit"))
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def repeated_chunks(rows: DataFrame, within: bool = False) -> DataFrame:
    """Chunks of ``text_rows`` that occur in two rows or more (``within``: at two places), each with its keeper.

    Chunks are cut again for the join instead of being stored.
    """
    owner = [F.col("doc_id").isNull().alias("nameless"), *_OWNER]
    found = chunks(rows).groupBy("hi", "lo").agg(
        F.min(F.struct(*owner, "place")).alias("first"), F.max(F.struct(*owner)).alias("last"), F.count(F.lit(1)).alias("n")
    )
    again = "n > 1" if within else "first.file <> last.file OR first.row <> last.row"
    keeper = {"keeper_id": "first.doc_id", "keeper_file": "first.file", "keeper_row": "first.row", "keeper_start": "first.place >> 16"}
    found = found.where(again).select("hi", "lo", *(F.expr(e).alias(c) for c, e in keeper.items()), "n")
    keepers = materialize(found, "chunk-keepers")
    count, total = keepers.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = keepers.where(F.col("n") * HOT_SHARE > total).select("hi", "lo", F.least("n", F.ceil(F.col("n") * HOT_SHARE / total)).cast("long").alias("parts"))
    hot = F.broadcast(hot)
    dealt = keepers.drop("n").join(hot, ["hi", "lo"], "left")
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part")).drop("parts")
    cut = chunks(rows, bit_map(keepers, count)).join(hot, ["hi", "lo"], "left")
    cut = cut.withColumn("part", F.coalesce(F.pmod(F.xxhash64("file", "row", "chunk"), "parts"), F.lit(0))).drop("parts")
    return cut.join(dealt, ["hi", "lo", "part"]).drop("hi", "lo", "part")


_SPAN = ["span_start", "span_end", "n_words", "n_chunks", "keeper_id", "keeper_start", "is_keeper"]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_SPAN_WORDS, within: bool = False) -> DataFrame:
    """One row per repeated span: document, byte range, words, the keeper's first byte, and whether this is the keeper.

    A run is a series of copied chunks with consecutive numbers, of ``min_words`` or more; a span is a stretch of it that
    lies in its keeper as a whole.  Where a run has a span that is long enough alone, what is left at either end counts as
    a run of its own: the first chunks of a passage depend on the bytes in front of it, so some copies share them by chance.
    The keeper's own chunks and further copies inside the keeper are told apart.  With ``within`` passages that lie twice in
    one text count as well.  Runs are found within one row's text, so no window is larger than a text.
    """
    return _spans(text_rows(*identified(docs), id_col, text_col), min_words, within).select("doc_id", *_SPAN)


def _spans(rows: DataFrame, min_words: int, within: bool = False) -> DataFrame:
    """Repeated spans with the place of their row."""
    copies = materialize(repeated_chunks(rows, within), "chunk-copies")
    copies = copies.withColumns({c: F.expr(e) for c, e in _PLACE.items()}).drop("place")
    copies = copies.withColumn("shift", F.col("start") - F.col("keeper_start"))
    line = Window.partitionBy("file", "row").orderBy("chunk")
    before = F.lag(F.struct(F.col("chunk") + 1, "keeper_file", "keeper_row", "shift")).over(line)
    joined = F.coalesce(before == F.struct("chunk", "keeper_file", "keeper_row", "shift"), F.lit(False))
    runs = copies.withColumn("run", F.col("chunk") - F.row_number().over(line)).withColumn("begins", F.when(joined, 0).otherwise(1))
    stretches = runs.withColumn("stretch", F.sum("begins").over(line)).groupBy("file", "row", "run", "stretch").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("span_start"),
        F.max(F.col("start") + F.col("bytes")).alias("span_end"),
        F.sum("words").alias("n_words"),
        F.count("*").alias("n_chunks"),
        F.first("keeper_id").alias("keeper_id"),
        F.min("keeper_start").alias("keeper_start"),
        F.first((F.col("file") == F.col("keeper_file")) & (F.col("row") == F.col("keeper_row")) & (F.col("shift") == 0)).alias("is_keeper"),
    )
    whole = Window.partitionBy("file", "row", "run")
    enough = F.when(F.col("n_words") >= min_words, F.col("stretch"))
    placed = stretches.withColumn("first", F.min(enough).over(whole)).withColumn("last", F.max(enough).over(whole))
    # the part of a run: 0 before and 2 behind the stretches that are long enough alone, 1 from the first to the last of them
    part = F.when(F.col("stretch") < F.col("first"), 0).when(F.col("stretch") > F.col("last"), 2).otherwise(1)
    counted = placed.withColumn("part", part).withColumn("part_words", F.sum("n_words").over(Window.partitionBy("file", "row", "run", "part")))
    return counted.where(F.col("part_words") >= min_words).select(*_OWNER, *_SPAN)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_SPAN_WORDS, within: bool = False) -> DataFrame:
    """``docs`` with every repeated span cut from the texts, except in the keeper.

    Neighbouring spans that others keep count together, and shorter ones stay: the first whole copy of a passage keeps the
    short parts that an earlier document has.
    """
    docs, row = identified(docs)
    line = Window.partitionBy("file", "row").orderBy("span_start", "span_end")
    spans = _spans(text_rows(docs, row, id_col, text_col), min_words, within).where("NOT is_keeper")
    apart = F.when(F.lag("span_end").over(line) >= F.col("span_start"), 0).otherwise(1)
    spans = spans.withColumn("apart", apart).withColumn("group", F.sum("apart").over(line))
    spans = spans.withColumn("group_words", F.sum("n_words").over(Window.partitionBy("file", "row", "group"))).where(F.col("group_words") >= min_words)
    listed = spans.groupBy("file", "row").agg(F.array_sort(F.collect_list(F.struct("span_start", "span_end"))).alias("spans"))
    cut, text = fresh(docs, "spans"), F.col(f"`{text_col}`").cast("string")
    joined = docs.join(listed.select(F.struct("file", "row").alias(row), F.col("spans").alias(cut)), row, "left")
    raw = F.col(f"`{text_col}`").cast("binary")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("out"))
    merged = F.aggregate(
        F.col(cut),
        state,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["span_end"]).alias("at"),
            F.concat(s["out"], F.substring(raw, (s["at"] + 1).cast("int"), F.greatest(F.lit(0), x["span_start"] - s["at"]).cast("int"))).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(raw, (s["at"] + 1).cast("int"), F.octet_length(raw))),
    )
    merged = F.when(F.col(cut).isNull(), text).otherwise(F.try_validate_utf8(merged.cast("string")))
    return joined.withColumn(text_col, merged).select(*(f"`{c}`" for c in docs.columns if c != row))
