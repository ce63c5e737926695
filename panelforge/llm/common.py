"""Helpers shared by the corpus operators: column names, row identity, Arrow passes over whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_type

from panelforge.storage import materialize

#: Words as the contracts define them: runs without the space and the characters 0x09 to 0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: A batch handed to Python holds at most so many rows and bytes unless the session says otherwise.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches for the session where the user has not."""
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(column: str) -> Column:
    """A never-null string key that keeps NULL apart from every value."""
    value = F.col(f"`{column}`").cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), value))


def seeded(*parts: Column | str) -> Column:
    """32 hex digits that order rows as a seeded shuffle; equal on every engine with MD5."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *columns).cast("binary"))


def unit_fraction(digest: Column) -> Column:
    """The first 13 hex digits as an exact double in [0, 1); ascending in the digest."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


#: So many ranges, blocks or stretches are one part of a running sum.
PART_ROWS = 4096


def sums_before(df: DataFrame, by: Sequence[str], part: Column, order: Sequence[str], **values: Column) -> DataFrame:
    """``df`` with the sum of each of ``values`` over earlier rows of its group (``name``) and over all of them (``name_all``).

    The sums are those of whole parts before plus those inside a part, so no task sorts a group: one level has a row for every
    part, the other the rows of one part.  ``part`` ascends with ``order``, which has no ties.
    """
    upper = fresh(df, "upper")
    parted = df.withColumn(upper, part)
    group, line = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(upper).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, upper).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    wholes = parted.groupBy(*by, upper).agg(*(F.sum(v).alias(n) for n, v in values.items()))
    wholes = wholes.select(*by, upper, *(F.coalesce(F.sum(n).over(line), F.lit(0)).alias(f"{n}_parts") for n in values), *(F.sum(n).over(group).alias(f"{n}_all") for n in values))
    parted = parted.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    joined = parted.join(wholes, [*by, upper])
    return joined.select(*df.columns, *((F.col(n) + F.col(f"{n}_parts")).alias(n) for n in values), *(f"{n}_all" for n in values))


def _is_scan(df: DataFrame) -> bool:
    plan = getattr(df, "_jdf", None)
    return plan is not None and plan.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


def identified(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column that tells every row, even repeated ones, apart.

    The identity is the row's place in a Parquet file, which stays the same in every pass and after the loss of an
    executor.  What is not a plain scan is written to the shared folder first.
    """
    name = fresh(docs, "row_id")
    own = [c for c in docs.columns if c.lower() == "_metadata"]
    if own or not _is_scan(docs) or not docs.inputFiles()[:1] or not docs.inputFiles()[0].endswith(".parquet"):
        hidden = fresh(docs, "kept_metadata")
        docs = materialize(docs.withColumnsRenamed({c: hidden for c in own}), "identified")
        out = docs.withColumn(name, _place())
        return out.withColumnsRenamed({hidden: c for c in own}), name
    return docs.withColumn(name, _place()), name


def _place() -> Column:
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def append_columns(docs: DataFrame, source: str, fields: list[tuple[str, str]], compute: Callable[[], Callable[[list[bytes | None]], list[list]]]) -> DataFrame:
    """Add columns computed in Python from the whole text of every row.

    ``compute()`` runs once per task and returns a function from the UTF-8 texts of a batch to one list per field.  All
    other columns pass through, so no join is needed to bring the result back to its row.  ``fields`` must not clash
    with columns of ``docs`` (see ``fresh``).
    """
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields)])
    place = docs.columns.index(source)
    kinds = [_ARROW.get(t) or to_arrow_type(T._parse_datatype_string(t)) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = compute()
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            made = measure(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made, kinds)], names=[*batch.schema.names, *(n for n, _ in fields)])

    return docs.mapInArrow(run, schema)


_CAPITALS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def ascii_lower(data: bytes) -> bytes:
    return data.translate(_CAPITALS)


def words_of(data: bytes | None) -> list[bytes]:
    """Words of ``WORD_PATTERN``: ``bytes.split`` cuts at exactly those six characters."""
    return data.split() if data else []


#: Capitals to small letters, and every ASCII character but letters and digits to a space.
_PLAIN = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

#: Words of ``plain`` texts, for engines with regular expressions, after A-Z became small.
PLAIN_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain(data: bytes) -> bytes:
    """Words of ASCII letters and digits and all other characters beyond ASCII, in small letters, with spaces between."""
    return data.translate(_PLAIN)


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def hex_escapes(pattern: str) -> str:
    """A pattern with its control characters written as escapes, for SQL text."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"\\x{ord(m[0]):02X}", pattern)
