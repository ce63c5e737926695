"""Quality rules judged per document and per host.

Every document is measured in one pass over its text.  Failures are then counted per host (any column that names where a
document comes from), the failure rates are shrunk with a beta prior fitted to all hosts by moments, and a host whose
shrunk rate is beyond the limit takes its other documents with it.

Defined results: a NULL or empty text has no words and fails; NULL hosts form one host; repeated rows each count and each
get a verdict, and so does a host at the limit, which is kept; very long texts are measured whole, in batches of bounded bytes;
an empty table gives an empty table; columns other than id, text and host are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import append_columns, key_of, words_of
from panelforge.storage import materialize

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

#: A host falls when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6

#: Counted hosts up to which their rates are broadcast.
BROADCAST_HOSTS = 200_000

#: Prior strength, in documents, where the rates of hosts differ no more than chance makes them.
STRONGEST_PRIOR = 1000.0

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = codes[:-1] * len(ids) + codes[1:]
    if len(ids) > 1_000_000:  # keeps the product below within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(ids) + codes[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    words = words_of(text)
    if not words:
        return 0, 0, len(text or b"") - len((text or b"").translate(None, SYMBOLS)), 0, 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _measures():
    return lambda texts: [list(column) for column in zip(*map(measure, texts), strict=True)] if texts else [[] for _ in MEASURES]


def document_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures and the base verdict of every row, without its text."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), key_of(host_col).alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"))
    measured = append_columns(narrow, "text", [(name, "long") for name in MEASURES], _measures).drop("text")
    short = F.col("n_words") < MIN_WORDS
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    return measured.withColumn("base_failed", short | repetitive)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Moments of the hosts' failure rates, less the spread that chance alone would give; one row reaches the driver."""
    row = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ss"),
        F.sum(F.col("n_docs") * F.col("n_docs")).alias("nn"),
    ).first()
    if not row["n"]:
        return 1.0, 1.0
    n, mean = float(row["n"]), row["f"] / row["n"]
    if mean <= 0.0 or mean >= 1.0:
        return mean * STRONGEST_PRIOR + 0.5, (1.0 - mean) * STRONGEST_PRIOR + 0.5
    # between-host variance by one-way analysis of variance on 0/1 outcomes
    scale = n - row["nn"] / n
    between = (row["ss"] - n * mean * mean) - (row["k"] - 1) * mean * (1.0 - mean)
    variance = between / scale if scale > 0.0 else 0.0
    strength = STRONGEST_PRIOR if variance <= 0.0 else min(STRONGEST_PRIOR, max(mean * (1.0 - mean) / variance - 1.0, 0.01))
    return mean * strength, (1.0 - mean) * strength


def host_rates(measured: DataFrame) -> DataFrame:
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    alpha, beta = beta_prior(hosts)
    return hosts.withColumn("host_rate", (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_host_rate: float = MAX_HOST_RATE, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """One row per document: measures, ``base_failed``, its host's shrunk rate and ``kept``."""
    measured = materialize(document_measures(docs, id_col, text_col, host_col), "host-measures")
    hosts = materialize(host_rates(measured).select("host", "host_rate"), "host-rates")
    # documents of a hot host stay where they are; beyond the bound the planner splits skewed parts
    judged = measured.join(F.broadcast(hosts) if hosts.count() <= broadcast_hosts else hosts, "host")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))
