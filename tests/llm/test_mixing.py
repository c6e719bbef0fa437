"""Mixing rates: the optimum of the least squares, held-out posteriors, and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybridge.llm import mixing, queries


def reference(tokens, p, goal, steps=20_000):
    """The same minimisation by plain projected gradient, run long."""
    weight = tokens / tokens.sum()
    gram = (p * weight[:, None]).T @ p
    scale, rate = 1 / gram.sum(1), np.ones(len(tokens))
    step = 1 / np.linalg.eigvalsh(gram * np.sqrt(np.outer(scale, scale)))[-1]
    for _ in range(steps):
        rate = np.maximum(0, rate - step * p @ (((weight * rate) @ p - goal) * scale))
    reached = (weight * rate) @ p
    return (scale * (reached - goal) ** 2).sum()


@pytest.mark.parametrize(("goal", "feasible"), [([0.6, 0.3, 0.1], True), ([0.02, 0.95, 0.03], False), ([1.2, 0.5, 0.4], True), ([0.0, 0.0, 1.0], False)])
def test_rates_minimise_the_distance(spark, goal, feasible):
    draw = np.random.default_rng(4)
    tokens, p = draw.integers(0, 500, 300), draw.dirichlet([0.3] * 3, 300)
    members = spark.createDataFrame(
        [(n, int(t), [float(x) for x in q]) for n, (t, q) in enumerate(zip(tokens, p, strict=True))], "n int, n_tokens long, posterior array<double>"
    )
    found, reached = mixing.fit_rates(members, goal)
    rates = np.array([r.rate for r in found.orderBy("n").collect()])
    assert found.columns == [*members.columns, "rate"] and (rates >= 0).all()
    totals = (tokens * rates) @ p / tokens.sum()
    assert np.abs(np.array(reached) / tokens.sum() - totals).max() < 1e-9
    if feasible:
        assert np.abs(totals - goal).max() <= mixing.TOLERANCE
    shares = (tokens @ p) / tokens.sum()
    assert ((totals - goal) ** 2 / shares).sum() <= reference(tokens, p, np.array(goal)) + 0.01  # of 0.7 to 1.9 at the start


def test_posteriors_tell_held_out_domains(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learned = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    asked = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 2 == 1)
    texts = docs.join(asked, "doc_id")
    found = mixing.mix_rates(texts.select(docs.columns).unionByName(docs.join(learned, "doc_id").select(docs.columns)), learned, queries.TARGETS, domain=queries.domain())
    p = found.join(asked.withColumn("domain", queries.domain()), "doc_id").select("posterior", "domain").toPandas()
    names = list(queries.TARGETS)
    right = [names[int(np.argmax(q))] == d for q, d in zip(p.posterior, p.domain, strict=True)]
    assert np.mean(right) > 0.9


def test_copies_have_the_rate_as_mean(spark):
    rows = spark.range(20_000).withColumn("rate", F.lit(1.3)).select(mixing.copies(F.col("rate"), 1, "id").alias("c"))
    assert set(r.c for r in rows.distinct().collect()) == {1, 2}
    assert abs(rows.agg(F.avg("c")).first()[0] - 1.3) < 0.02


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 1), (6, 0, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    found = mixing.mix_rates(edge, labels, queries.TARGETS, domain=queries.domain()).collect()
    assert len(found) == edge.count() and all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (3, 4, 5)} == {0}
    assert len({r.rate for r in found if r.doc_id == 7}) == 1
    mixed = mixing.mixed(edge, labels, queries.TARGETS, domain=queries.domain())
    assert mixed.columns == edge.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    wanted = {}
    for r in mixing.mix_rates(edge, labels, queries.TARGETS, domain=queries.domain()).withColumn("c", mixing.copies(F.col("rate"), 1, "doc_id", "row_hash")).collect():
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.c
    assert times == {k: v for k, v in wanted.items() if v}
    assert mixing.mixed(nothing, labels, queries.TARGETS, domain=queries.domain()).count() == 0
    unlabelled = mixing.mix_rates(edge, labels.limit(0), queries.TARGETS, domain=queries.domain())
    assert len({tuple(r.posterior) for r in unlabelled.collect()}) == 1


def test_the_cap_on_labelled_rows_leaves_the_prior(spark):
    """Texts without terms get the domains' shares among all labelled rows, cut by the cap or not."""
    rows = [(n, f"plain prose {n}", 1, 0) for n in range(80)] + [(100 + n, f"win win {n}", 0, 0) for n in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(-1, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in rows], "doc_id long, quality int, toxic int")
    odds = []
    for cap in (20, 1000):
        sample = mixing.labelled_sample(
            docs, labels, label=queries.domain(), allowed=F.lit(True), id_column="doc_id", text_column="text", per_label=cap
        )
        share = sample.groupBy("y").agg(F.sum("weight").alias("n")).collect()
        assert {r.y: round(r.n) for r in share} == {"good": 80, "poor": 20}
        bias = mixing.fit(sample.withColumn("text", F.lit("")), ["good", "poor"]).bias
        odds.append(bias[0] - bias[1])
    assert abs(odds[0] - np.log(4)) < 1e-6 and abs(odds[1] - np.log(4)) < 1e-6


def test_labelled_rows_are_drawn_among_the_given_documents(spark):
    """Of many poor ones few are left; a draw that looks at the labels alone would miss most of them."""
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(1000) if n < 100 or n % 30 == 0], "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n < 100), 0) for n in range(1000)], "doc_id long, quality int, toxic int")
    sample = mixing.labelled_sample(
        docs, labels, label=queries.domain(), allowed=F.lit(True), id_column="doc_id", text_column="text", per_label=30
    )
    found = {r.y: (r.n, round(r.w)) for r in sample.groupBy("y").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert found == {"good": (30, 100), "poor": (30, 30)}


def test_every_domain_is_drawn_however_many(spark):
    docs = spark.range(140).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    labels = docs.select("doc_id", F.format_string("d%02d", F.col("doc_id") % 70).alias("domain"))
    sample = mixing.labelled_sample(
        docs, labels, label=F.col("domain"), allowed=F.lit(True), id_column="doc_id", text_column="text", per_label=1
    )
    assert sample.select("y").distinct().count() == 70
