import re
import string
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from panelforge.llm import license_join, queries
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.llm.twins import against_sql
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def most_shared(words, template):
    """Words of a template in the block that holds most of them, every block tried."""
    known = set(template.words)
    return max((len(known.intersection(words[i : i + template.span])) for i in range(len(words))), default=0)


def slow_scan(text):
    words = words_of(text)
    starts, base = [], set()
    for phrase, label in license_join.PHRASES:
        own = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        starts += hits
        base |= {label} if hits else set()
    labels, best = set(base), 1.0 if starts else 0.0
    for t in license_join.template_sets(license_join.TEMPLATES, license_join.CONTAINMENT):
        shared = most_shared(words, t)
        if shared >= t.needed:
            labels.add(t.label)
            best = max(best, shared / len(t.words))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(best, 6)


NOTICES = [
    "MIT License mit license, Apache-License; the GNU General Public License",
    "released under MIT License today\nAll rights reserved.",
    "Licensed under the Apache license version 2",
    "mit  licenses MITLICENSE mit_license",
    "This program is free software you can redistribute it or modify it under the terms of the GNU General Public License",
    "Licensed under CC\nBY-NC 4.0 all rights\nreserved",
    "général public license MIT\tLICENSE",
    "license mit license",
    "/* Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and\n * associated documentation files */",
    "# Redistribution and use in source and binary forms, with or\n# without modification, are permitted provided that the\n# following conditions are met:",
    "all Germans reserved their human rights",
    "all the " + "filler words here " * 40 + "rights of cc stand here and by far from nc or from 4 men and 0 women are licensed at last under what is reserved",
    "head " * 5000 + "Released under\nthe MIT License " + "tail " * 5000,
    "All rights\n\nreserved",
]


def notices(spark):
    rows = [(100 + i, t) for i, t in enumerate(NOTICES)]
    return awkward_documents(spark).union(documents(spark, rows))


def test_scan_against_brute_force(spark):
    docs = notices(spark)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    found = Counter((r["doc_id"], *(r[c] for c in columns)) for r in license_join.scan(docs).collect())
    assert found == Counter((r["doc_id"], *slow_scan(r["text"])) for r in docs.collect())


def test_wrapped_notices_are_found_and_long_lines_are_not(spark):
    labels = {r["doc_id"]: r["labels"] for r in license_join.scan(notices(spark)).where("doc_id >= 108").collect()}
    assert labels == {108: "mit", 109: "bsd", 110: "", 111: "", 112: "mit", 113: "proprietary"}


@pytest.mark.parametrize("piece_words", [1, 7, 50])
def test_notices_across_pieces(spark, monkeypatch, piece_words):
    monkeypatch.setattr(license_join, "PIECE_WORDS", piece_words)
    test_scan_against_brute_force(spark)


def test_scan_against_sql(spark):
    against_sql(notices(spark), license_join.scan, license_join.sql())


def test_filters_lose_no_match(spark):
    """Every block against every template, for several thresholds: the join finds what plain comparison finds."""
    texts = [" ".join(w for k, w in enumerate(words_of(t)) if (k + i) % (i + 2)) for i in range(5) for _, t in license_join.TEMPLATES]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)])
    for containment in (0.5, 0.75, 1.0):
        sets = license_join.template_sets(license_join.TEMPLATES, containment)
        found = {r["doc_id"]: r["labels"] for r in license_join.scan(docs, containment=containment).collect()}
        for i, t in enumerate(texts):
            expected = {s.label for s in sets if most_shared(words_of(t), s) >= s.needed}
            base = {label for phrase, label in license_join.PHRASES if f" {phrase} " in f" {' '.join(words_of(t))} "}
            assert found[i] == ",".join(sorted(expected | base))


def test_scan_of_an_empty_table(spark):
    assert license_join.scan(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_against_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL).toPandas()
    assert compare(found, connect(SMALL).sql(queries.ORACLES[name]).df()) == "ok"


def test_every_operator_is_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_native_operators_use_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("op3_temperature_mix", "op7_proportional_shards", "op10_license_join"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|RDD", plan), name
    del docs


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = corpus_pipeline.stage_path(spark, name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "simhash_near_dedup":
            assert docs.select("doc_id").distinct().count() == sizes[-1]
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3] <= sizes[4]
    last = corpus_pipeline.run(spark, SMALL)
    assert last.count() == sizes[4] and {"shard", "slot"} <= set(last.columns)


def test_pipeline_stages_take_awkward_rows(spark):
    docs = awkward_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_documents(spark), SMALL).count() == 0
