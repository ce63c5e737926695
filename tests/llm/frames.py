"""Small frames with the cases that every corpus operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, shard int, leaks string"

_LINE = "one two three four five six seven eight nine ten eleven twelve"


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def awkward_documents(spark):
    """NULLs in every column, empty, wordless and very long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"w{i * 7919 % 5003} x{i % 13}," for i in range(4_000))
    texts = {
        1: _LINE,
        2: _LINE,
        3: _LINE.upper(),
        4: "",
        5: None,
        6: " \n\t ",
        7: long_text,
        8: long_text + " and a tail",
        9: "a",
        10: "été à l'école\nété à l'école\n# * $ % & | < >",
        11: "\n".join([_LINE] * 6),
        12: "nul\x00 inside and   and   other spaces \U0001f600",
        13: "<|endoftext|> it's 2024's <|startoftext|>ABC",
    }
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t), "r", i, None) for i, t in texts.items()]
    rows += [rows[0], rows[0], rows[3], (None, _LINE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows as documents."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), None, None, None) for r in rows], SCHEMA)
