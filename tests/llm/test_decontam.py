"""Benchmark matches against brute force, DuckDB, and edge rows."""

import hashlib
import random
import re

import pytest

from tallybridge.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = {}
    for key, text in docs.items():
        doc, hit, found = words(text), set(), set()
        for item, passage in items:
            own = words(passage)
            n = min(len(own), window)
            for i in range(len(own) - n + 1) if n else ():
                for j in range(len(doc) - n + 1):
                    if doc[j : j + n] == own[i : i + n]:
                        hit.update(range(j, j + n))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[key] = (len(doc), len(hit), len(found), digest, bool(hit))
    return out


@pytest.mark.parametrize("window", [1, 3, 10])
def test_as_brute_force(spark, window):
    draw = random.Random(window)
    text = lambda n: " ".join(draw.choice("the of and a to In, x1 é ß 東京".split()) for _ in range(n))
    items = [(n, text(draw.choice([0, 1, 2, 3, 12, 30]))) for n in range(12)] + [(3, "the of the of the of the of the of the of"), (40, None)]
    docs = {n: text(80) for n in range(30)}
    for n in range(30, 45):
        item = words(draw.choice(items)[1])
        cut = draw.randrange(len(item) + 1)
        docs[n] = f"{text(5)} {' '.join(item[cut:])} {text(5)} {' '.join(item[: cut + 9])}"
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(frame, benchmark, window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found} == brute(docs, items, window)


def test_edge_rows(spark, edge, nothing):
    items = [(1, "QUICK brown fox jumps over the lazy dog near the river bank"), (2, "one"), (3, ""), (4, None), (None, "one"), (5, "tail5 word6 tail6 word7")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contamination(edge, benchmark).collect()
    assert len(rows) == edge.count()
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in rows}
    assert found[1] == found[2] == (14, 12, 1) and found[6] == (1, 1, 1) and found[7] == (120_000, 4, 1)
    assert found[3] == found[4] == found[5] == (0, 0, 0) and found[None] == (8, 0, 0)
    assert decontam.contamination(nothing, benchmark).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(edge, benchmark.limit(0)).collect())


def test_large_tables_take_the_shuffled_way(spark, edge, monkeypatch):
    benchmark = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the river bank"), (2, "one")], "item_id long, text string")
    wanted = sorted(map(str, decontam.contamination(edge, benchmark).collect()))
    monkeypatch.setattr(decontam, "SENT_ROWS", 0)
    assert sorted(map(str, decontam.contamination(edge, benchmark).collect())) == wanted


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x a q b c z"), (2, "a b c"), (3, "c b a"), (4, "a q q q b c")], "doc_id long, text string")
    items = decontam.item_words(spark.createDataFrame([(7, "a b c")], "item_id long, text string"))
    index = decontam.build_index(docs, items)
    near = {(r.doc_id, r.item_id) for r in decontam.proximity_matches(index, items, 3, slop=1).collect()}
    assert near == {(1, 7), (2, 7)}
    assert {r.doc_id for r in decontam.proximity_matches(index, items, 3, slop=3).collect()} == {1, 2, 4}


def near_items(docs, items, window, slop):
    """Items with a window near enough, per document; windows follow their rarest word."""
    own = {(str(item), tuple(words(passage))) for item, passage in items if words(passage)}
    texts = {key: words(text) for key, text in docs.items()}
    often = {}
    for text in texts.values():
        for word in text:
            often[word] = often.get(word, 0) + 1
    out = {key: set() for key in docs}
    for item, passage in own:
        n = min(len(passage), window)
        for i in range(len(passage) - n + 1):
            part = passage[i : i + n]
            if any(word not in often for word in part):
                continue
            rare = min(range(n), key=lambda j: (often[part[j]], j))
            for key, text in texts.items():
                for pos in (p for p, word in enumerate(text) if word == part[rare]):
                    due = [(max(0, pos + j - rare - slop), pos + j - rare + slop + 1) for j in range(n)]
                    if all(j == rare or part[j] in text[max(a, 0) : max(b, 0)] for j, (a, b) in enumerate(due)):
                        out[key].add(item)
    return {key: len(found) for key, found in out.items()}


@pytest.mark.parametrize("window, slop", [(1, 0), (2, 1), (4, 0), (5, 2)])
def test_proximity_as_brute_force(spark, window, slop):
    draw = random.Random(window)
    text = lambda n: " ".join(draw.choice("the of and a to In, x1 é ß 東京 rare seldom".split()) for _ in range(n))
    items = [(n, text(draw.choice([0, 1, 2, 3, 6, 9]))) for n in range(10)] + [(3, "the of the of the of"), (40, None), (41, "absent the")]
    docs = {n: text(40) for n in range(25)} | {30: "", 31: None}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(frame, benchmark, window=window, slop=slop).collect()
    wanted = near_items(docs, items, window, slop)
    assert {r.doc_id: r.n_near for r in found} == wanted and any(wanted.values())
    assert all(r.n_near >= r.n_items for r in found)


def test_stays_native(spark, sf):
    docs, benchmark = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    items = decontam.item_words(benchmark)
    index = decontam.build_index(docs, items)
    for found in (decontam.phrase_matches(index, items), decontam.proximity_matches(index, items)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
