"""Exact top-k against brute force, with ties, several shards and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score double, rank string"


def brute(rows, k):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)))
    out = []
    for q, a in dict.fromkeys(whole):
        if q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(frame, is_query=F.col("vec_id") % 50 == 0, k=k).collect())


@pytest.mark.parametrize(("shard", "queries", "leaf"), [(8192, 2048, 64), (40, 3, 4)])
def test_as_brute_force(spark, monkeypatch, shard, queries, leaf):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries)
    monkeypatch.setattr(topk, "LEAF_ROWS", leaf)
    draw = np.random.default_rng(1)
    rows = [(n, [float(x) for x in np.float32(draw.standard_normal(6))]) for n in range(400)]
    rows += [(n, rows[50][1]) for n in range(400, 520)]  # one vector many times, queries among them
    rows += [(520, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, rows[0][1])]
    rows += [(700, [1.0, 2.0]), (701, [3.0, -1.0]), (750, []), (751, []), rows[0], rows[3]]
    assert found(spark, rows) == brute(rows, 5)


def test_fewer_than_k_and_none(spark):
    assert found(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 256 * 512)]
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []


def test_repeated_rows_are_a_candidate_each(spark):
    assert found(spark, [(0, [1.0]), (7, [2.0]), (7, [2.0]), (8, [1.0])]) == [(0, 1, 7, 131072), (0, 2, 7, 131072), (0, 3, 8, 65536)]
    many = [(0, [1.0]), (0, [1.0])] + [(7, [2.0])] * 30 + [(8, [3.0])] * 2
    assert found(spark, many) == brute(many, 5) == [(0, n + 1, v, s) for n, (v, s) in enumerate([(8, 196608)] * 2 + [(7, 131072)] * 3)]


def test_regions_out_of_reach_are_not_searched(spark, monkeypatch):
    """Clustered vectors, a third of them equal: few of the pairs of query and shard are met, and nothing is lost."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    draw = np.random.default_rng(3)
    middles = draw.standard_normal((20, 8))
    middles /= np.sqrt((middles**2).sum(1))[:, None]
    rows = [(n, [float(x) for x in np.float32(middles[n % 20] + 0.03 * draw.standard_normal(8))]) for n in range(1200)]
    rows = [(n * 7 % 1201, v) for n, v in rows]
    rows += [(n, [float(x) for x in np.float32(middles[0])]) for n in range(1201, 1800)]
    asked = []
    searched = topk._searched

    def counted(vectors, queries, by, k):
        asked.append((vectors.select("dim", "region", "shard").distinct().count(), queries.count()))
        return searched(vectors, queries, by, k)

    monkeypatch.setattr(topk, "_searched", counted)
    assert found(spark, rows) == brute(rows, 5)
    (shards, queries), (_, away) = asked
    assert queries == 36 and shards > 20 and away < 0.6 * queries * (shards - 1)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**21, 1.0]), (1, [2.0**22, 0.00390625]), (2, [2.0**22, 0.0078125])]
    assert found(spark, rows) == brute(rows, 5)
