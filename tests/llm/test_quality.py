import re
from collections import Counter

import pytest

from panelforge.llm import quality_hosts
from panelforge.llm.quality_sql import sql
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.llm.twins import against_sql


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures_against_brute_force(spark):
    docs = awkward_documents(spark)
    texts = Counter((r["doc_id"], slow_measures(r["text"])) for r in docs.collect())
    found = quality_hosts.document_measures(docs).collect()
    assert Counter((r["doc_id"], tuple(r[m] for m in quality_hosts.MEASURES)) for r in found) == texts


def test_base_verdict_limits(spark):
    unique = [f"w{i}" for i in range(100)]
    cases = {1: unique[:49], 2: unique[:50], 3: unique[:50] + ["a", "b", "c"] * 20, 4: unique[:60] + ["a", "b", "c"] * 20}
    docs = documents(spark, [(k, " ".join(v)) for k, v in cases.items()])
    failed = {r["doc_id"]: r["base_failed"] for r in quality_hosts.judge(docs).collect()}
    assert failed == {1: True, 2: False, 3: True, 4: False}


def test_a_bad_host_takes_its_clean_documents_and_a_small_one_does_not(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    rows = [(i, clean, "good") for i in range(200)]
    rows += [(1000 + i, "short" if i % 20 else clean, "bad") for i in range(200)]
    rows += [(2000, "short", "tiny"), (2001, clean, "tiny")] + [(3000 + i, clean if i % 10 else "short", f"h{i % 7}") for i in range(140)]
    verdict = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_hosts.judge(documents(spark, rows)).collect()}
    assert verdict[0] == (False, True)
    assert verdict[1000] == (False, False)  # clean, on the bad host
    assert verdict[2001] == (False, True)  # one failure of two is drawn towards the prior
    assert not any(kept for failed, kept in verdict.values() if failed)


@pytest.mark.parametrize("text", ["", "short"])
def test_all_failing_and_none_failing(spark, text):
    clean = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text or clean, "s") for i in range(5)]
    assert [r["kept"] for r in quality_hosts.judge(documents(spark, rows)).collect()] == [not text] * 5


def test_against_sql(spark):
    against_sql(awkward_documents(spark), quality_hosts_query, sql())


def quality_hosts_query(docs):
    judged = quality_hosts.judge(docs)
    return judged.selectExpr("doc_id", *quality_hosts.MEASURES, "base_failed", "kept", "round(host_rate, 6) AS host_failure_rate")


def test_empty_table(spark):
    assert quality_hosts.judge(empty_documents(spark)).count() == 0


def test_hosts_joined_either_way_agree(spark):
    docs = awkward_documents(spark)
    both = [Counter(map(tuple, quality_hosts.judge(docs, broadcast_hosts=n).select("doc_id", "host_rate", "kept").collect())) for n in (0, 100)]
    assert both[0] == both[1] and sum(both[0].values()) == docs.count()
