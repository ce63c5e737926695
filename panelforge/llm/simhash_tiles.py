"""SimHash near-duplicates by exact tiled comparison.

Distinct fingerprints are laid out in tiles.  All of a tile's fingerprints have the same four population counts, one per
16-bit word; the distance of two fingerprints is at least the sum of the differences of these counts, so only tile pairs
whose counts differ by the radius or less in sum are compared, and those completely, with numpy exclusive-or and bit
counts.  Tiles are cut by hash at a fixed expected size, so a large group of near copies spreads over many tasks.  A tile
pair returns links to the smallest linked fingerprint, at most one per member, never all its pairs; links become
components by alternating stars.

Defined results: NULL and wordless texts have fingerprint zero and link like any other; repeated rows are linked; a bit set in just half the
shingles is 0; very long texts are read whole, in batches of bounded bytes; a
component without any id has a NULL component; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import append_columns, ascii_lower, bounded_batches, identified
from panelforge.llm.components import stars
from panelforge.storage import materialize

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42

#: Expected fingerprints in a tile, and rows of the left tile compared at once.
TILE_ROWS = 2048
STRIP_ROWS = 256

_WORDS, _WORD_BITS = 4, 16


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, repeats included."""
    words = ascii_lower(text).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
    for at in range(0, len(spans), 4096):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans[at : at + 4096]], np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (total * 2 > len(spans)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text_col: str, name: str, width: int = SHINGLE_WORDS) -> DataFrame:
    return append_columns(docs, text_col, [(name, "long")], lambda: lambda texts: [[fingerprint(t, width) for t in texts]])


def _population(column: str) -> list:
    mask = (1 << _WORD_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(F.col(column), _WORD_BITS * i).bitwiseAND(F.lit(mask))).cast("int") for i in range(_WORDS)]


def _shape(counts: list):
    """The four counts as one integer."""
    out = F.lit(0)
    for c in counts:
        out = out * F.lit(64) + c
    return out


def neighbour_steps(radius: int) -> list[tuple[int, int]]:
    """Shifts of the combined counts to every later shape within the radius, and whether the shape is the same."""
    steps = set()
    for move in product(range(-radius, radius + 1), repeat=_WORDS):
        if sum(map(abs, move)) <= radius and move >= (0,) * _WORDS:
            steps.add((sum(m * 64 ** (_WORDS - 1 - i) for i, m in enumerate(move)), int(any(move))))
    return sorted(steps)


def linked_to_smallest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs within ``radius`` connect: at most one for each member."""
    both = np.concatenate((left, right))
    label = np.arange(len(both))
    split = len(left)
    strips = []
    a, b = left.view(np.uint64), right.view(np.uint64)
    for at in range(0, split, STRIP_ROWS):
        near = np.bitwise_count(a[at : at + STRIP_ROWS, None] ^ b[None, :]) <= radius
        rows, columns = np.nonzero(near.any(axis=1))[0], np.nonzero(near.any(axis=0))[0]
        if len(rows):
            strips.append((rows + at, columns + split, near[np.ix_(rows, columns)]))
    changed = bool(strips)
    while changed:
        changed = False
        for rows, columns, near in strips:
            low = np.minimum(label[rows], np.where(near, label[columns][None, :], len(both)).min(axis=1))
            across = np.minimum(label[columns], np.where(near, low[:, None], len(both)).min(axis=0))
            if (low < label[rows]).any() or (across < label[columns]).any():
                changed = True
                label[rows], label[columns] = low, across
    moved = np.nonzero(label != np.arange(len(both)))[0]
    return both[moved], both[label[moved]]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            lists = [batch.column(i) for i in range(2)]
            values = [x.values.to_numpy(zero_copy_only=False) for x in lists]
            ends = [x.offsets.to_numpy() for x in lists]
            for i in range(batch.num_rows):
                a, b = (v[e[i] : e[i + 1]] for v, e in zip(values, ends, strict=True))
                x, y = linked_to_smallest(a, b, radius)
                if len(x):
                    found.append((x, y))
            if found:
                a, b = (np.concatenate(column) for column in zip(*found, strict=True))
                keep = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links between distinct fingerprints (column ``fp``) that connect exactly what pairs within ``radius`` connect."""
    bounded_batches(prints.sparkSession)
    shaped = prints.select("fp", _shape(_population("fp")).alias("shape"))
    # at most 17^4 = 83,521 shapes exist: a proven bound
    pieces = shaped.groupBy("shape").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("pieces"))
    cut = shaped.join(F.broadcast(pieces), "shape").withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")))
    tiles = materialize(cut.groupBy("shape", "piece").agg(F.collect_list("fp").alias("members")), "tiles")
    steps = F.array(*(F.struct(F.lit(step).alias("step"), F.lit(other).alias("other")) for step, other in neighbour_steps(radius)))
    left = tiles.select("piece", F.col("members").alias("l"), "shape", F.explode(steps).alias("x"))
    left = left.select("piece", "l", (F.col("shape") + F.col("x.step")).alias("shape"), F.col("x.other").alias("other"))
    right = tiles.select("shape", F.col("piece").alias("with_piece"), F.col("members").alias("r"))
    pairs = left.join(right, "shape").where("other = 1 OR piece <= with_piece").select("l", "r")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return pairs.mapInArrow(_links(radius), schema)


def near_duplicates(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Distinct ``fp`` with ``root``, the smallest fingerprint reachable over links."""
    distinct = materialize(prints.select("fp").distinct(), "prints")
    roots = stars(links(distinct, radius, tile_rows)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: its fingerprint and the smallest id of its component."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    printed = materialize(with_fingerprints(narrow, "text", "fp", width).drop("text"), "fingerprints")
    roots = near_duplicates(printed, radius)
    smallest = printed.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = materialize(smallest.join(roots, "fp"), "classes")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    members = named.join(lowest, "root").select("fp", "component_id")
    return printed.join(members, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of every component; among repeated rows, the first in storage."""
    docs, row = identified(docs)
    narrow = docs.select(F.col(row).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    printed = materialize(with_fingerprints(narrow, "text", "fp", width).drop("text"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    smallest = printed.groupBy("fp").agg(first.alias("first"))
    keepers = smallest.join(near_duplicates(printed, radius), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return docs.join(keepers.select(F.col("first.row").alias(row)), row, "left_semi").drop(row)
