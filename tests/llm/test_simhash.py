"""Fingerprints, their links and groups, against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tallybridge.llm import queries, simhash
from tallybridge.llm.components import connected_components


def plain_fingerprint(text, shingle=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, max_bits):
    """The index of the first member, by repeated relabelling."""
    values = np.array(prints, np.uint64)
    label = np.arange(len(values))
    while True:
        new = label.copy()
        for i in range(len(values)):
            new[i] = label[np.bitwise_count(values ^ values[i]) <= max_bits].min()
        if (new == label).all():
            return label
        label = new


def test_fingerprints(edge):
    for row in edge.collect():
        assert simhash.fingerprint(row.text) == plain_fingerprint(row.text), row.doc_id


@pytest.mark.parametrize(("block_rows", "max_bits"), [(512, 2), (3, 2), (2, 3)])
def test_groups_as_brute_force(spark, block_rows, max_bits):
    """Clusters of up to hundreds of near fingerprints, below and above the block bound."""
    draw = random.Random(5)
    prints = [draw.getrandbits(64) for _ in range(200)]
    for centre in prints[:4]:
        prints += [centre ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(60)]
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.links_within(spark.createDataFrame([(v,) for v in signed], "fp long"), max_bits, block_rows)
    found = {r.node: r.component for r in connected_components(links).distinct().collect()}
    wanted = groups(prints, max_bits)
    mine = [found.get(v, v) for v in signed]
    assert len(set(zip(mine, wanted.tolist(), strict=True))) == len(set(mine)) == len(set(wanted.tolist()))


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(n, n + 1) for n in range(100, 160)] + [(7, n) for n in range(1000, 1300)] + [(5, 5), (3, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {found[n] for n in range(100, 161)} == {100} and {found[n] for n in range(1000, 1300)} == {7}
    assert 5 not in found and 3 not in found


def test_query_as_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    first = groups(prints, 2)
    wanted = {r.doc_id: (f"{p:016x}", rows[f].doc_id) for r, p, f in zip(rows, prints, first.tolist(), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, sf).collect()} == wanted


def test_edge_rows(edge, nothing):
    found = sorted(((r.doc_id or 0), r.fp == 0, r.component_id) for r in simhash.near_copies(edge).collect())
    by_id = {i: c for i, _, c in found}
    assert by_id[2] == 1 and by_id[4] == by_id[5] == 3 and [i for i, zero, _ in found if zero] == [3, 4, 5]
    assert [c for i, _, c in found if i == 7] == [7, 7] and by_id[0] is None
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9]
    assert simhash.near_copies(nothing).count() == simhash.one_of_each(nothing).count() == 0
