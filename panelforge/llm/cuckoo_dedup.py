"""Exact deduplication with a cuckoo-filter index of live digests.

The index is a written table, one row per shard.  A shard is a cuckoo filter: buckets of four slots, each with a 16-bit mark
of a SHA-256 digest and the number of the stored key it stands for; a digest may lie in two buckets, the second found from
the first and the mark.  A digest whose mark is in neither bucket is new.  A mark that is found is verified against the whole
digest stored for that slot, so false positives never join different texts (digests of 256 bits stand for the texts themselves,
which are not moved).  An insertion into full buckets moves marks on; when too many moves do not free a slot, the table is
doubled and filled again from the stored keys.  Deletion clears the slot of a verified digest.

A stored key carries the size of its group and the row that stays: the largest id, then the first place in the files.
Rows go through tasks that put copies together before the shuffle, so a group that holds a third of all rows reaches its
shard as one row per task.  Shards are dealt by hash and their number follows the counted rows; an index whose shards have
outgrown that is dealt anew from its stored keys.  Group facts are joined back to the rows: groups with more than one in
``HOT_SHARE`` rows, fewer than ``HOT_SHARE`` of them by count, are broadcast, all others shuffled.

Defined results: NULL and empty texts are equal to each other; very long texts are digested whole; a row without an id stays only
if no copy has one; of repeated rows with the largest id, the first place in the files stays; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, identified
from panelforge.storage import materialize

SLOTS = 4
MAX_MOVES = 200
SHARD_KEYS = 50_000
TASK_KEYS = 50_000
HOT_SHARE = 10_000

_DIGEST = 32
_KEY = "digest binary, doc_id long, file long, row long, n long"
_INDEX = "shard int, shards int, marks binary, refs binary, digests binary, doc_ids array<long>, files array<long>, rows array<long>, sizes array<long>"

#: A stored key's payload: id, file and row of the row that stays, and rows of the group.
Payload = tuple[int | None, int, int, int]


def _later(a: Payload, b: Payload) -> Payload:
    """The payload of two parts of one group."""
    first, second = ((p[0] is not None, p[0] or 0, -p[1], -p[2]) for p in (a, b))
    return (*(a if first >= second else b)[:3], a[3] + b[3])


class CuckooIndex:
    """A cuckoo filter with the keys that its slots stand for."""

    def __init__(self, buckets: int = 64) -> None:
        self.digests: list[bytes | None] = []
        self.payloads: list[Payload] = []
        self.live = self.resizes = self.false_hits = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.refs = array("i", bytes(4 * SLOTS * buckets))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """The mark (never 0) and both buckets."""
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x9E3779B1 >> 7 & self.mask)

    def _slot(self, digest: bytes) -> int:
        """The slot that stands for a digest, -1 if there is none."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark:
                    if self.digests[self.refs[slot]] == digest:
                        return slot
                    self.false_hits += 1
        return -1

    def get(self, digest: bytes) -> Payload | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.payloads[self.refs[slot]]

    def _place(self, ref: int) -> bool:
        """Give a stored key a slot, moving others on; False when that takes too many moves."""
        mark, bucket, second = self._places(self.digests[ref])
        for at in (bucket, second):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.refs[slot] = mark, ref
                    return True
        for move in range(MAX_MOVES):
            slot = bucket * SLOTS + (mark + move) % SLOTS
            mark, self.marks[slot] = self.marks[slot], mark
            ref, self.refs[slot] = self.refs[slot], ref
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.refs[slot] = mark, ref
                    return True
        return False

    def _resize(self) -> None:
        """Twice the buckets, filled again from the stored keys."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            if all(self._place(ref) for ref, digest in enumerate(self.digests) if digest is not None):
                return

    def insert(self, digest: bytes, payload: Payload) -> bool:
        """Whether the digest is new; otherwise its group grows."""
        slot = self._slot(digest)
        if slot >= 0:
            ref = self.refs[slot]
            self.payloads[ref] = _later(self.payloads[ref], payload)
            return False
        self.digests.append(digest)
        self.payloads.append(payload)
        self.live += 1
        if not self._place(len(self.digests) - 1):
            self._resize()
        return True

    def delete(self, digest: bytes) -> bool:
        """Whether the digest was there; it leaves with its whole group."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.digests[self.refs[slot]] = None
        self.marks[slot] = 0
        self.live -= 1
        return True

    def columns(self) -> dict:
        """The shard as a row: stored keys without those deleted, slots numbered anew."""
        kept = [ref for ref, digest in enumerate(self.digests) if digest is not None]
        number = np.zeros(len(self.digests) + 1, np.int32)
        number[kept] = np.arange(len(kept))
        refs = number[np.frombuffer(self.refs, np.int32)]
        ids, files, rows, sizes = zip(*(self.payloads[r] for r in kept), strict=True) if kept else ((),) * 4
        return {"marks": self.marks.tobytes(), "refs": refs.tobytes(), "digests": b"".join(self.digests[r] for r in kept), "doc_ids": ids, "files": files, "rows": rows, "sizes": sizes}

    @classmethod
    def of(cls, row: dict) -> CuckooIndex:
        """The shard of a row of the index."""
        made = cls(len(row["marks"]) // (2 * SLOTS))
        made.marks, made.refs = array("H", row["marks"]), array("i", row["refs"])
        made.digests = [row["digests"][a : a + _DIGEST] for a in range(0, len(row["digests"]), _DIGEST)]
        made.payloads = list(zip(row["doc_ids"], row["files"], row["rows"], row["sizes"], strict=True))
        made.live = len(made.digests)
        return made


def digest_of(text_col: str = "text") -> Column:
    """SHA-256 of the whole text in UTF-8."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"), 256))


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest``, ``doc_id`` and the row's place, for every row."""
    marked, row = identified(docs)
    return marked.select(digest_of(text_col).alias("digest"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"{row}.file").alias("file"), F.col(f"{row}.row").alias("row"))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a task as one row."""
    names = [f.split()[0] for f in _KEY.split(", ")]
    kinds = [pa.binary(), *[pa.int64()] * 4]

    def rows(held: dict[bytes, Payload]) -> pa.RecordBatch:
        columns = zip(*((d, *p) for d, p in held.items()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    held: dict[bytes, Payload] = {}
    for batch in batches:
        for digest, *place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = (*place, 1)
            held[digest] = _later(held[digest], own) if digest in held else own
        if len(held) >= TASK_KEYS:
            yield rows(held)
            held = {}
    if held:
        yield rows(held)


def keys_of(rows: DataFrame) -> DataFrame:
    """Digests with payload from ``digest_rows``; the same digest once per task or so."""
    bounded_batches(rows.sparkSession)
    return rows.select("digest", "doc_id", "file", "row").mapInArrow(_together, _KEY)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _dealt(index: DataFrame | None, keys: DataFrame, gone: DataFrame | None, shards: int) -> DataFrame:
    """Every shard with its changes: digests of ``gone`` leave, then ``keys`` enter."""
    spark = keys.sparkSession
    changes = keys.withColumn("enters", F.lit(True))
    if gone is not None:
        nothing = {c: F.lit(None).cast("long") for c in ("doc_id", "file", "row", "n")}
        changes = changes.unionByName(gone.select("digest").distinct().withColumns(nothing).withColumn("enters", F.lit(False)))
    changes = changes.withColumn("shard", _shard(shards))
    before = spark.createDataFrame([], _INDEX) if index is None else index

    def run(held: pa.Table, changed: pa.Table) -> pa.Table:
        own = CuckooIndex.of(held.to_pylist()[0]) if held.num_rows else CuckooIndex()
        shard = (held if held.num_rows else changed).column("shard")[0].as_py()
        lists = [changed.column(c).to_pylist() for c in ("enters", "digest", "doc_id", "file", "row", "n")]
        for enters, digest, *_ in zip(*lists, strict=True):
            if not enters:
                own.delete(digest)
        for enters, digest, *payload in zip(*lists, strict=True):
            if enters:
                own.insert(digest, tuple(payload))
        columns = {"shard": shard, "shards": shards} | own.columns()
        long = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), long, long, long, long]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(columns.values(), kinds, strict=True)], names=list(columns))

    return before.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(run, _INDEX)


def stored_keys(index: DataFrame) -> DataFrame:
    """The keys that an index stores, with their payload."""
    zipped = F.arrays_zip("doc_ids", "files", "rows", "sizes")
    rows = index.select("digests", F.posexplode(zipped).alias("at", "k"))
    return rows.select(F.substring("digests", F.col("at") * _DIGEST + 1, F.lit(_DIGEST)).alias("digest"), F.col("k.doc_ids").alias("doc_id"), F.col("k.files").alias("file"), F.col("k.rows").alias("row"), F.col("k.sizes").alias("n"))


def update(index: DataFrame | None, rows: DataFrame | None = None, gone: DataFrame | None = None, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The index after digests of ``gone`` left and ``rows`` (as of ``digest_rows``) entered; written anew.

    A digest that leaves takes its whole group with it.  Without an index one is begun.
    """
    spark = (rows if rows is not None else gone if index is None else index).sparkSession
    keys = materialize(keys_of(rows), "digest-keys") if rows is not None else spark.createDataFrame([], _KEY)
    if index is None:
        shards = max(1, math.ceil(keys.count() / shard_keys))
    else:
        shards, stored = index.agg(F.max("shards"), F.sum(F.size("doc_ids"))).first()
        shards = shards or 1
        total = (stored or 0) + keys.count()
        if total > 2 * shards * shard_keys:
            shards = math.ceil(total / shard_keys)
            index = materialize(_dealt(None, stored_keys(index), None, shards), "cuckoo-shards")
    return materialize(_dealt(index, keys, gone, shards), "cuckoo-shards")


def _facts(rows: DataFrame, index: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """``rows`` with the payload of their digests as ``keep_id``, ``keep_file``, ``keep_row``, ``group_size``."""
    names = {"doc_id": "keep_id", "file": "keep_file", "row": "keep_row", "n": "group_size"}
    keys = stored_keys(index).withColumnsRenamed(names)
    total = index.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    hot = F.broadcast(keys.where(F.col("group_size") * hot_share > total))
    cold = keys.where(F.col("group_size") * hot_share <= total)
    return rows.join(hot, "digest").unionByName(rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per document: the id that stays of its group, the group's size, whether this row stays, the digest."""
    rows = materialize(digest_rows(docs, id_col, text_col), "digests")
    found = _facts(rows, update(None, rows, shard_keys=shard_keys))
    stays = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return found.select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    marked, row = identified(docs)
    rows = marked.select(digest_of(text_col).alias("digest"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"{row}.file").alias("file"), F.col(f"{row}.row").alias("row"))
    rows = materialize(rows, "digests")
    found = _facts(rows, update(None, rows)).where("NOT (file = keep_file AND row = keep_row)")
    return marked.join(found.select(F.struct("file", "row").alias(row)), row, "left_anti").drop(row)


def known(docs: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text is live in the index: their id, the id that stays there, its group's size."""
    return _facts(digest_rows(docs, id_col, text_col), index).select("doc_id", "keep_id", "group_size")


def sql() -> str:
    """DuckDB text for ``groups`` of ``documents``."""
    return """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST, row) = 1 AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)
"""
