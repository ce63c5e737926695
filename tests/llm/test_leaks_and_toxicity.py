import random
import re
from collections import Counter, defaultdict
from math import ceil, comb, exp, log
from zlib import crc32

import pytest
import xxhash

from panelforge.llm import template_leaks, toxic_automaton
from tests.llm.frames import awkward_documents, documents, empty_documents

ITEM = "A train leaves Boston at 9 with 120 passengers and travels 300 km to reach Albany where 45 passengers leave the train for good."


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "item_id long, text string")


def found(spark, texts, benchmark, **settings):
    rows = template_leaks.leaked_pairs(documents(spark, list(enumerate(texts))), items(spark, benchmark), **settings).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_verbatim_and_reparameterised_items(spark):
    other = ITEM.replace("Boston", "Paris").replace("Albany", "New Lyon").replace("120", "80").replace("300", "1,250").replace("45", "7")
    texts = [f"{prose(1, 40)}\n{ITEM}\n{prose(2, 40)}", f"{prose(3, 20)}. {other} {prose(4, 20)}", prose(5, 100), ITEM.upper().lower()]
    rows = found(spark, texts, [ITEM, prose(9, 30)])
    assert set(rows) == {(0, 1), (1, 1)}
    assert not rows[0, 1]["reparameterised"] and rows[0, 1]["containment"] == 1.0
    assert rows[1, 1]["reparameterised"] and rows[1, 1]["n_changed"] >= 5


def test_inconsistent_slots_are_no_leak(spark):
    item = "We asked Ada to add 5 and 5 and then told Ada to take 5 away again before noon came."
    same = item.replace("5", "9").replace("Ada", "Bob")
    mixed = item.replace("add 5 and 5", "add 5 and 6")
    rows = found(spark, [same, mixed], [item], min_containment=0.9)
    assert set(rows) == {(0, 1)}


def test_copies_in_other_letters(spark):
    """As the registered query and the pipeline run it."""
    german = "Der Hund von Anna sah im Garten hinter dem Haus einen Vogel und die Katze auf dem Dach der Scheune am Bach."
    short = "Name the Capital of Northern Freedonia in Summer"
    texts = [ITEM.upper().lower(), ITEM.upper(), f"{prose(1, 30)} {german.lower()} {prose(2, 30)}", f"{prose(3, 9)} {short} {prose(4, 9)}", ITEM, prose(5, 90)]
    rows = found(spark, texts, [ITEM, german, short], plain_names=True)
    assert set(rows) == {(0, 1), (1, 1), (2, 2), (3, 3), (4, 1)}
    assert all(r["containment"] == 1.0 and not r["reparameterised"] for r in rows.values())
    other = ITEM.replace("Boston", "Paris").replace("Albany", "New Lyon").replace("120", "80")
    assert found(spark, [other], [ITEM], plain_names=True)[0, 1]["reparameterised"]


def test_equal_numbers_asked_again_as_different_ones(spark):
    item = f"{prose(31, 14)} 3 pens and {prose(32, 14)}. Then 3 books came {prose(33, 14)}"
    again = item.replace("3 pens", "4 pens").replace("3 books", "7 books")
    altered = item.replace("3 books", "8 books")
    other = item.replace("3 books", "5 books")
    merged = other.replace("3 pens", "4 pens").replace("5 books", "4 books")
    rows = found(spark, [again, altered, merged], [item, other])
    assert {(0, 1), (1, 1), (2, 1), (2, 2)} <= set(rows)
    assert rows[1, 1]["n_changed"] == 0 and 0.5 <= rows[0, 1]["containment"] < 1.0 and rows[2, 1]["containment"] == 1.0


def test_names_and_units_are_typed():
    memo = template_leaks.Templates()
    h, slots, _, _ = memo.template(b"The dog of Ann Lee weighs 5 kg. Then 5 cats came.")
    one, other = memo.template(b"the dog of Bob weighs 17 lbs. Then 6 cats came."), (h, slots)
    assert one[0].tolist() == other[0].tolist() and one[1].tolist() == [False, False, False, True, False, True, True, False, True, False, False]


def test_short_items_use_one_window_and_the_way_of_joining_changes_nothing(spark):
    benchmark = ["five short words in all", "too few words", None, "", ITEM, ITEM]
    texts = [f"{prose(i, 10)}\n{b}\n{prose(i + 50, 10)}" for i, b in enumerate(benchmark)]
    whole = found(spark, texts, benchmark)
    assert set(whole) == {(0, 1), (4, 5), (4, 6), (5, 5), (5, 6)}
    assert set(found(spark, texts, benchmark, broadcast_windows=0)) == set(whole)


def test_planted_items_and_nothing_else(spark):
    benchmark = [prose(10_000 + i, 12 + i) for i in range(30)]
    texts = [f"{prose(i, 60)}\n{benchmark[i % 30]}\n{prose(20_000 + i, 30)}" if i % 2 else prose(i, 80) for i in range(200)]
    assert set(found(spark, texts, benchmark)) == {(i, i % 30 + 1) for i in range(1, 200, 2)}


def test_stage_passes_all_columns(spark):
    docs = awkward_documents(spark)
    kept = template_leaks.without_leaks(docs, items(spark, ["one two three four five six seven eight nine ten"]))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7, 8, 9, 10, 12, 13, None}
    assert template_leaks.without_leaks(empty_documents(spark), items(spark, [ITEM])).count() == 0
    assert template_leaks.leaked_pairs(docs, items(spark, [])).count() == 0


def slow_template(text, plain_names):
    """Template words, and for each the hash of its slot's value or None, word by word."""
    out, before, line = [], None, True
    edges = template_leaks._EDGES
    tokens = [t for line in text.split("\n") for t in [*line.encode().split(), None]]
    for raw in tokens:
        word = raw and raw.decode()
        core = (word or "").strip(edges)
        if core:
            low, last = core.lower(), out[-1] if out else None
            kind = low
            if re.match(r"[+-]?\d[\d.,:/^x*+-]*[a-z%]{0,3}$", low):
                kind = "<number>"
            elif low in template_leaks.UNITS and last and last["kind"] == "<number>":
                kind = "<unit>"
            elif not plain_names and core[0].isupper() and not core.isupper() and not line and not (before or "").rstrip("\"'”’)»").endswith((".", "!", "?", ":")):
                kind = "<name>"
            if kind == "<name>" and last and last["kind"] == "<name>":
                last["raw"].append(word)
            else:
                out.append({"kind": kind, "raw": [word]})
        elif word and out:
            out[-1]["raw"].append(word)
        before, line = word, word is None
    slots = [w["kind"] in ("<number>", "<unit>", "<name>") for w in out]
    values = [" ".join(w["raw"]).strip(edges).lower().encode() for w in out]
    seeds = [int(template_leaks._PLACEHOLDER[w["kind"][1:-1]]) if s else 0 for w, s in zip(out, slots, strict=True)]
    return [w["kind"] for w in out], [xxhash.xxh64_intdigest(v, seed) >> 1 if s else None for v, seed, s in zip(values, seeds, slots, strict=True)]


def slow_coverage(item, doc):
    """Windows of the item that the document has under one mapping, slots compared, slots changed; every window against every other."""
    (a, mine), (b, theirs) = item, doc
    size = min(template_leaks.WINDOW, len(a))
    if size < template_leaks.MIN_WORDS or None not in mine:
        return None
    number, lines = len(a) - size + 1, defaultdict(list)
    for there in range(number):
        for place in range(len(b) - size + 1):
            if a[there : there + size] == b[place : place + size]:
                lines[place - there].append(there)
    mapped, covered, spots_used = [], set(), []
    for shift, starts in sorted(lines.items(), key=lambda x: (-len(x[1]), x[0])):
        if len(covered) == number:
            break
        spots = {t: (mine[t], theirs[t + shift]) for start in starts for t in range(start, start + size) if mine[t] is not None}
        times, agreed = Counter(spots.values()), set(mapped)
        for pair in sorted(times, key=lambda p: (p[0] != p[1], -times[p], p)):
            if all((pair[0] == x) == (pair[1] == y) for x, y in agreed):
                agreed.add(pair)
        good = [start for start in starts if all(spots[t] in agreed for t in range(start, start + size) if t in spots)]
        used = [spots[t] for t in sorted({t for start in good for t in range(start, start + size) if t in spots})]
        mapped += used
        spots_used += used
        covered.update(good)
    return len(covered) / number, len(covered), len(spots_used), sum(x != y for x, y in spots_used)


def slow_leaks(texts, benchmark, plain_names):
    out = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(benchmark, 1):
            both = [slow_coverage(slow_template(item, k), slow_template(text, k)) for k in ([False, True] if plain_names else [False])]
            best = max((c for c in both if c), key=lambda c: c[0], default=None)
            if best and best[0] >= template_leaks.MIN_CONTAINMENT:
                out[d, i] = best
    return out


def question(r):
    """Words of a small vocabulary, with numbers, units, names, marks and line ends, so that windows meet in many ways."""
    plain = ["the train", "leaves at", "and then", "how many", "are left", "she took", "of", "in", "to"]
    slots = [lambda: str(r.randint(1, 4)), lambda: f"{r.randint(1, 3)} km", lambda: r.choice(["Ann", "Bob Lee", "Rome", "Oslo"]), lambda: r.choice([".", "-", "?\nThen"])]
    return " ".join(r.choice(slots)() if r.random() < 0.4 else r.choice(plain) for _ in range(r.randint(4, 22)))


def asked_again(r, text):
    """Other numbers and names, equal ones alike or not, and sometimes other letters or a lost word."""
    for old in ("1", "2", "3", "Ann", "Rome"):
        text = text.replace(old, r.choice([old, "7", "Ann", "Oslo"]) if old.isalpha() else str(r.randint(1, 9)), r.choice([1, -1]))
    words = text.split(" ")
    if r.random() < 0.3:
        del words[r.randrange(len(words))]
    return r.choice([str, str, str.lower, str.upper])(" ".join(words))


@pytest.mark.parametrize("plain_names", [False, True])
def test_query_against_every_window(spark, plain_names):
    r = random.Random(12)
    benchmark = [question(r) for _ in range(25)]
    texts = [" ".join([question(r), asked_again(r, r.choice(benchmark)), question(r)]) for _ in range(60)]
    texts += [f"{asked_again(r, benchmark[i])}\n{asked_again(r, benchmark[i])}" for i in range(20)] + ["1 km 2 km 3 4 " * 30]
    rows = found(spark, texts, benchmark, plain_names=plain_names)
    expected = slow_leaks(texts, benchmark, plain_names)
    got = {k: (v["containment"], v["n_windows"], v["n_slots"], v["n_changed"]) for k, v in rows.items()}
    assert got == expected and len(got) > 40 and any(v["reparameterised"] for v in rows.values())


def test_repeats_of_an_item_stream_by(spark, monkeypatch):
    """A document that repeats an item, with other numbers each time, and long tables of numbers, in tiny batches."""
    monkeypatch.setattr(template_leaks, "bounded_batches", lambda spark: None)
    item = f"{prose(41, 6)} 3 pens and 4 books for 5 pupils {prose(42, 6)}"
    table = "rates were 1 2 3 4 5 6 7 8 9 10 in all and more to come"
    many = "\n".join(item.replace("3", str(i)).replace("4", str(i + 1)) for i in range(600))
    numbers = " ".join(str(i % 97) for i in range(3000))
    texts = [many, f"{many}\n{item}", numbers, f"{numbers}\n{table}", prose(43, 200)]
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        rows = found(spark, texts, [item, table])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(rows) == {(0, 1), (1, 1), (3, 2)} and all(v["containment"] == 1.0 for v in rows.values())
    got = {k: (v["containment"], v["n_windows"], v["n_slots"], v["n_changed"]) for k, v in rows.items()}
    assert got == slow_leaks(texts, [item, table], False)


def test_map_of_windows_grows_with_their_number(spark, monkeypatch):
    """A map of few bits lets more windows through and changes no result."""
    benchmark = [prose(500 + i, 30) for i in range(40)]
    texts = [f"{prose(i, 30)}\n{benchmark[i]}" for i in range(40)]
    known = template_leaks.item_windows(items(spark, benchmark))
    sizes = [len(template_leaks._bit_map(known, n)) * 8 for n in (0, 1 << 22, 1 << 40)]
    assert sizes == [1 << 24, 1 << 27, 1 << 27]
    whole = found(spark, texts, benchmark)
    monkeypatch.setattr(template_leaks, "MIN_BITS", 8)
    monkeypatch.setattr(template_leaks, "MAX_BITS", 8)
    assert found(spark, texts, benchmark) == whole and set(whole) == {(i, i + 1) for i in range(40)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def slow_match(word, terms):
    """Closest term by comparing with all of them; a stem with every beginning of the word."""
    best = None
    for number, term in enumerate(terms):
        base = term.rstrip("*")
        d = min(distance(word[:n], base) for n in range(len(word) + 1)) if term.endswith("*") else distance(word, base)
        if d <= toxic_automaton.edits_allowed(len(base)) and (best is None or (d, number) < best):
            best = (d, number)
    return best


def test_automaton_against_all_distances():
    terms = ["moron", "scum", "worthless", "vequ*", "lowei*", "lowe", "idiotic*", "idiot"]
    automaton, r = toxic_automaton.Automaton(terms), random.Random(3)
    for _ in range(6000):
        word = list(r.choice(terms).rstrip("*") + r.choice(["", "", "x", "lich"]))
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(word))
            word[at : at + r.randint(0, 1)] = r.choice(["", "a", "e", "o", "w", "mo"])
        word = "".join(word)
        assert automaton.match(word) == slow_match(word, terms), word


@pytest.mark.parametrize(("text", "at", "expected"), [
    ('He is a moron and that is all', 3, 0),
    ('The sign read "you moron go home" and stayed', 4, 1),
    ('then someone called moron loudly', 3, 1),
    ('"Fine words" before a moron here', 4, 0),
    ('a «moron» there', 1, 1),
])
def test_context_window(text, at, expected):
    assert toxic_automaton.quotation([w.encode() for w in text.split()], at) == expected


def labelled(spark, n=1200):
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        if i % 8 == 0:
            words.insert(i % 50, ["numbskull", "dimwit", f"flarg{'abcdefg'[i // 8 % 7] * 3}"][i // 8 % 3])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 8 == 0)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_and_misspellings(spark):
    docs, labels = labelled(spark)
    scored = {r["doc_id"]: r for r in toxic_automaton.score(docs, labels).collect()}
    held = [i for i in scored if scored[i]["held_out"]]
    assert held == [i for i in scored if crc32(str(i).encode()) % 5 == 0]
    wrong = [i for i in held if scored[i]["predicted"] != int(i % 8 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    model = toxic_automaton.fit(docs, labels)
    assert {"numbskull", "dimwit"} <= set(model.terms) and "flarg*" in model.terms
    check = documents(spark, [(1, prose(1, 30) + " numbskul " + prose(2, 30)), (2, prose(3, 60)), (3, "he wrote numbskul to us")])
    score = {r["doc_id"]: r["s"] for r in toxic_automaton.with_scores(check, model, "text", "s").collect()}
    assert score[1] >= 0.5 > score[2] and score[3] < score[1]


def test_copies_of_one_toxic_text_teach_no_words(spark):
    copied = prose(77, 40).replace(" ", " ", 1)
    rows = [(i, copied + " numbskull" if i % 8 == 0 else prose(i, 40)) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    assert toxic_automaton.fit(documents(spark, rows), labels).terms == []


def test_awkward_rows_and_missing_labels(spark):
    docs = awkward_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = toxic_automaton.score(docs, none).collect()
    assert len(scored) == docs.count() and {r["score"] for r in scored} == {0.0}
    _, labels = labelled(spark, 40)
    odd = labels.union(spark.createDataFrame([(None, None, 1), (3, None, None), (1, 1, 1), (1, 1, 0)], labels.schema))
    assert toxic_automaton.score(docs, odd).count() == docs.count()
    kept = toxic_automaton.without_toxic(docs, odd)
    assert kept.columns == docs.columns
    assert toxic_automaton.score(empty_documents(spark), labels).count() == 0


def insults(spark, n_insults, texts_each, clean):
    """Made-up insults (letters drawn at random), each in texts of its own among prose, and clean prose."""
    r = random.Random(11)
    words = set()
    while len(words) < n_insults:
        words.add("".join(r.choice("bcdfghjklmnpqrstvwxz") + r.choice("aeiou") for _ in range(5)))
    rows, labels, vocabulary = [], [], prose(5, 1500).split()
    for i in range(n_insults * texts_each + clean):
        text = [vocabulary[int(1500 * r.random() ** 2)] for _ in range(25)]
        if i < n_insults * texts_each:
            text.insert(i % 23 + 1, sorted(words)[i // texts_each])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i < n_insults * texts_each)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("n_insults", "texts_each", "clean"), [(700, 20, 6000), (900, 12, 4000)])
def test_many_terms_and_mostly_toxic_labels(spark, n_insults, texts_each, clean):
    docs, labels = insults(spark, n_insults, texts_each, clean)
    toxic = n_insults * texts_each
    held = [r for r in toxic_automaton.score(docs, labels).collect() if r["held_out"]]
    found = [r["predicted"] for r in held if r["doc_id"] < toxic]
    alarms = [r["predicted"] for r in held if r["doc_id"] >= toxic]
    assert sum(found) >= 0.95 * len(found) and sum(alarms) <= 0.01 * len(alarms)


def test_a_model_without_terms_rejects_nothing(spark):
    rows = [(i, prose(i, 30)) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 > 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    scored = toxic_automaton.score(documents(spark, rows), labels).collect()
    assert {r["predicted"] for r in scored} == {0}


def test_words_joined_by_punctuation_match():
    matcher = toxic_automaton.Matcher(["idiot", "moron"])
    for text in ("moron—you", "idiot/clown", "worthless-moron", "you.idiot.", "big_idiot..now"):
        assert matcher.features(text.encode()), text
    assert not matcher.features("well-known more/on e-mail".encode())


def test_texts_needed_against_the_definition():
    held = [(n, 400 // n, 3 if n > 8 else 0) for n in range(1, 60)]
    for share in (0.05, 0.3, 0.8):
        needed = toxic_automaton.texts_needed(held, share)
        kept = [row for row in held if row[0] >= needed]
        odds = {n: toxic_automaton.chance_of(n, share) for n, *_ in held}
        assert all(abs(odds[n] - sum(comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(ceil(0.9 * n), n + 1))) < 1e-9 for n in odds)
        expected = sum((t - p) * odds[n] / (1 - odds[n]) for n, t, p in kept)
        assert needed >= 3 and (not kept or expected <= max(0.5, 0.001 * sum(p for *_, p in kept)))


def test_scores_against_plain_counts(spark):
    """Weights and scores worked out again from the labelled texts, each word compared with every term."""
    docs, labels = labelled(spark, 400)
    model = toxic_automaton.fit(docs, labels)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def features(text):
        words = text.encode().split()
        hits = [(i, slow_match(toxic_automaton.bare(w), model.terms)) for i, w in enumerate(words)]
        hits = [(i, h) for i, h in hits if h]
        chosen = [(i, h) for i, h in hits if h[0] == 0] or hits
        return {(term, int(d > 0), toxic_automaton.quotation(words, i)) for i, (d, term) in chosen}

    train = [i for i in texts if crc32(str(i).encode()) % 5]
    held = {i: features(t) for i, t in texts.items()}
    n = [sum(toxic[i] == c for i in train) for c in (0, 1)]

    def seen(feature, c):
        return sum(toxic[i] == c and (feature in held[i] if feature else not held[i]) for i in train)

    def ratio(feature):
        return log((seen(feature, 1) + 0.5) / (n[1] + 1)) - log((seen(feature, 0) + 0.5) / (n[0] + 1))

    def towards(feature, assumed):
        rows = seen(feature, 0) + seen(feature, 1)
        return (rows * ratio(feature) + 2 * assumed) / (rows + 2)

    prior, weights = log(n[1] / n[0]), {}
    for k in range(len(model.terms)):
        weights[k, 0, 0] = ratio((k, 0, 0))
        weights[k, 1, 0] = towards((k, 1, 0), 0.75 * weights[k, 0, 0])
        for m in (0, 1):
            weights[k, m, 1] = towards((k, m, 1), 0.5 * weights[k, m, 0])
    assert model.terms and model.weights == pytest.approx(weights)
    for r in toxic_automaton.score(docs, labels).collect():
        own = sorted((weights[f] for f in held[r["doc_id"]]), reverse=True)
        total = prior + (own[0] + 0.1 * sum(w for w in own[1:] if w > 0) if own else ratio(None))
        expected = 1 / (1 + exp(-total))
        assert r["score"] == pytest.approx(expected if own else min(0.49, expected))
