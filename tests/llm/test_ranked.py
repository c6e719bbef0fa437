"""Ranked search against brute force, in its cases and with everything cut small."""

import math
import re
from collections import Counter

import pytest

from tallybridge.llm import ranked

DOCS = "doc_id long, text string, lang string, score double, shard int, `term.x` string"
ITEMS = "item_id string, text string, rank int"


def terms_of(text):
    return re.findall(ranked.TERM_PATTERN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(doc_id, terms_of(text)) for doc_id, text in docs]
    n, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(term for _, t in held for term in set(t))
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms_of(text))
    out = []
    for item, terms in asked.items():
        found = []
        for doc_id, own in held:
            counts, score = Counter(own), 0
            for term in terms:
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    m = 25 + (75 * len(own) * n) // length
                    score += w * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "en", 0.1, 1, "t") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, 1) for i in items], ITEMS),
    )


CORPUS = [(n, " ".join(f"w{(n * j) % (7 + j)}" for j in range(1, 3 + n % 9)) + " the" * (n % 4) + f" rare{n % 50}") for n in range(400)]
CORPUS += [(7, "The THE the É é"), (7, "The THE the É é"), (None, "rare3 w1"), (None, ""), (500, None), (501, "  ...  "), (502, "w1 " * 50_000)]
ASKED = [("a", "the w1 rare3"), ("b", "W1 w1, w2-w3 é"), ("c", "nowhere"), ("d", None), ("e", ""), (None, "rare7 the"), ("f", "É"), ("a", "w5")]


@pytest.mark.parametrize("cut", ["as it is", "small", "joined terms"])
def test_against_brute_force(spark, monkeypatch, cut):
    if cut == "small":
        monkeypatch.setattr(ranked, "BUNDLE", 2)
        monkeypatch.setattr(ranked, "PIECE", 5)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    if cut == "joined terms":
        monkeypatch.setattr(ranked, "SENT_TERMS", 2)
    try:
        docs, items = frames(spark, CORPUS, ASKED)
        found = sorted((tuple(r) for r in ranked.rank(docs, items, k=4).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute(CORPUS, ASKED, 4)


def test_empty_tables(spark):
    docs, items = frames(spark, CORPUS[:3], ASKED)
    assert ranked.rank(docs.limit(0), items).collect() == []
    assert ranked.rank(docs, items.limit(0)).collect() == []
    assert ranked.rank(docs.filter("doc_id < 0"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_dropping_accumulators_loses_nothing_and_drops(spark):
    """Documents that cannot come in any more leave before the last owner, and the ranking is whole."""
    docs = [(n, "often " + ("sel " * (1 + n % 5) if n % 20 == 0 else "") + "pad " * (n % 11)) for n in range(2000)]
    items = [("q", "often sel")]
    found = sorted((tuple(r) for r in ranked.rank(*frames(spark, docs, items), k=3).collect()), key=repr)
    assert found == brute(docs, items, 3)
