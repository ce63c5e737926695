"""Token ids as Arrow files of equal-length sequences with masks.

Documents are sorted by id over range partitions; every task encodes its documents, ends each with the end id, and writes
one Arrow IPC file whose batches hold a fixed number of fixed-size lists: ``ids`` (16-bit where the vocabulary allows) and
``mask``.  Buffers are not compressed, so a memory-mapped file gives sequence k without a copy, as row k % batch of batch
k // batch.  Only the last sequence of a file is padded (mask false).  A second Arrow file lists the file's documents with
their place.  Files are written under an attempt's name and moved into place, so a task that runs again after the loss of an
executor leaves one whole file.  Folders are any that Arrow's file systems reach: local, HDFS, object stores.

Defined results: NULL and empty texts have the end id alone; documents without an id come first; repeated rows are written
each time, in storage order; an empty table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, identified
from panelforge.llm.token_encoder import encoder
from panelforge.storage import materialize, stage_path

SEQUENCE = 2_048
BATCH_SEQUENCES = 64
END_ID = 2

_MANIFEST = "part int, file string, docs_file string, n_docs long, n_tokens long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class SequenceWriter:
    """One file of sequences, written batch by batch."""

    def __init__(self, sink, dtype: np.dtype, length: int, batch: int) -> None:
        self.length, self.batch, self.dtype = length, batch, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held: list[bytes] = []
        self.held_bytes = self.tokens = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.tokens += len(ids) // self.dtype.itemsize
        full = self.length * self.batch * self.dtype.itemsize
        if self.held_bytes >= full:
            data = b"".join(self.held)
            whole = len(data) // full * full
            for at in range(0, whole, full):
                self._write(np.frombuffer(data[at : at + full], self.dtype), self.length * self.batch)
            self.held = [data[whole:]]
            self.held_bytes = len(data) - whole

    def _write(self, ids: np.ndarray, used: int) -> None:
        mask = pa.array(np.arange(len(ids)) < used)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.held), self.dtype)
        if len(rest):
            padded = np.zeros(-(-len(rest) // self.length) * self.length, self.dtype)
            padded[: len(rest)] = rest
            self._write(padded, len(rest))
        self.writer.close()


def _write(folder: str, tokenizer_path: str, end_id: int, length: int, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        tokens = encoder(tokenizer_path)
        dtype = np.dtype(tokens.width)
        context = TaskContext.get()
        files, base = _place(folder)
        files.create_dir(base, recursive=True)
        name, attempt = f"part-{context.partitionId():06d}", uuid.uuid4().hex
        end, start, n_docs = dtype.type(end_id).tobytes(), 0, 0
        with files.open_output_stream(f"{base}/.{name}-{attempt}.ids") as ids_sink, files.open_output_stream(f"{base}/.{name}-{attempt}.docs") as docs_sink:
            sequences = SequenceWriter(ids_sink, dtype, length, batch)
            listed = pa.ipc.new_file(docs_sink, _DOCS)

            def all_batches():
                yield first
                yield from batches

            for rows in all_batches():
                counts = []
                for text in rows.column(1).cast(pa.binary()):
                    ids = tokens.encode(text.as_py()) + end
                    sequences.add(ids)
                    counts.append(len(ids) // dtype.itemsize)
                ends = start + np.cumsum(np.array(counts, np.int64))
                starts = ends - counts
                listed.write_batch(pa.RecordBatch.from_arrays([rows.column(0), pa.array(starts), pa.array(counts, pa.int64())], schema=_DOCS))
                start, n_docs = int(ends[-1]) if counts else start, n_docs + len(counts)
            sequences.close()
            listed.close()
        for kind in ("ids", "docs"):
            files.move(f"{base}/.{name}-{attempt}.{kind}", f"{base}/{name}.{kind}.arrow")
        row = [[context.partitionId()], [f"{folder}/{name}.ids.arrow"], [f"{folder}/{name}.docs.arrow"], [n_docs], [start]]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["part", "file", "docs_file", "n_docs", "n_tokens"])

    return run


def write_sequences(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, length: int = SEQUENCE, batch_sequences: int = BATCH_SEQUENCES,
) -> DataFrame:
    """Write the files and return their manifest (one row per file, in order of ``part``), itself a written table."""
    bounded_batches(docs.sparkSession)
    folder = folder or stage_path(docs.sparkSession, "sequences")
    marked, row = identified(docs)
    narrow = marked.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(row).alias("place"))
    ordered = narrow.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    return materialize(ordered.mapInArrow(_write(folder, tokenizer_path, end_id, length, batch_sequences), _MANIFEST), "manifest")


def _open(uri: str):
    files, path = _place(uri)
    return pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path)


class SequenceFile:
    """Random access to the sequences of one file; values are views of the mapped file."""

    def __init__(self, uri: str) -> None:
        self.reader = pa.ipc.open_file(_open(uri))
        self.length = self.reader.schema.field("ids").type.list_size
        self.batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        self._number, self._values = -1, np.array([])

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        rows = self.reader.get_batch(k // self.batch)
        at = k % self.batch
        ids = rows.column(0).flatten().slice(at * self.length, self.length).to_numpy()
        return ids, rows.column(1).flatten().slice(at * self.length, self.length)

    def _flat(self, number: int) -> np.ndarray:
        if number != self._number:
            self._number, self._values = number, self.reader.get_batch(number).column(0).flatten().to_numpy()
        return self._values

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of consecutive batches."""
        each = self.batch * self.length
        while count:
            number, offset = divmod(start, each)
            found = self._flat(number)[offset : offset + count]
            yield found
            start, count = start + len(found), count - len(found)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for manifest in batches:
        for uri, docs_uri, before in zip(*(manifest.column(i).to_pylist() for i in range(3)), strict=True):
            sequences = SequenceFile(uri)
            listed = pa.ipc.open_file(_open(docs_uri))
            for number in range(listed.num_record_batches):
                rows = listed.get_batch(number)
                sums = []
                for start, count in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                    value = 0
                    for ids in sequences.tokens(start, count):
                        value = crc32(ids.astype("<u4").tobytes(), value)
                    sums.append(value)
                starts = pa.array(rows.column(1).to_numpy() + before)
                yield pa.RecordBatch.from_arrays([rows.column(0), starts, rows.column(2), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_sequences(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: where its ids start in the whole, how many they are, and their checksum."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    files = max(1, manifest.count())
    spread = placed.select("file", "docs_file", "before").repartition(files, "file")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
