"""Comparison of an operator over a frame with its SQL twin over the same rows."""

import duckdb

from tests.oracle import compare


def against_sql(docs, build, text):
    duck = duckdb.connect()
    found = build(docs).toPandas()
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    duck.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert compare(found, duck.sql(text).df()) == "ok"
