"""Quality votes: held-out accuracy, the exact neighbour vote, and edge rows."""

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from tallybridge.llm import quality, queries
from tallybridge.llm.common import in_fold


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op5_quality(spark, sf).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(scored) > 50
    assert ((scored.predicted == 1) == (scored.quality == 1)).mean() > 0.95
    assert scored.score.between(0, 1).all()


def test_votes_as_plain_loops():
    draw = np.random.default_rng(2)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(draw.standard_normal((n, 7)))
    labelled, asked, y = unit(90), unit(40), draw.integers(0, 2, 90).astype(float)
    found = quality.votes(asked, labelled, y, 0.5)
    for vector, score in zip(asked, found, strict=True):
        cosine = [float(vector @ other) for other in labelled]
        near = sorted(range(90), key=lambda i: -cosine[i])[: quality.NEIGHBOURS]
        weight = [max(cosine[i], 0) ** quality.SHARPNESS for i in near]
        assert abs(score - sum(w * y[i] for w, i in zip(weight, near, strict=True)) / sum(weight)) < 1e-4


def test_a_text_longer_than_a_piece_counts_whole():
    text = "alpha beta gamma " * 100_000
    (_, _, whole), (_, _, short) = (next(quality.term_rows(pa.array([t]))) for t in (text, text[: 17 * 300]))
    assert np.abs(whole - short).max() < 0.02


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (None, 1), (3, None)], "doc_id long, quality int")
    name = quality.clear_of(edge, "score")
    found = quality.score_quality(edge, labels)
    assert found.columns == [*edge.columns, name] and name != "score"
    rows = found.collect()
    assert len(rows) == edge.count() and all(0 <= r[name] <= 1 for r in rows)
    empty = {r[name] for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1 and abs(empty.pop() - 2 / 3) < 1e-6
    by_id = {r.doc_id: r[name] for r in rows}
    assert abs(by_id[1] - by_id[2]) < 1e-3 and min(by_id[1], by_id[2]) > by_id[9]
    assert quality.score_quality(nothing, labels).count() == 0
    none = labels.limit(0)
    assert {r[name] for r in quality.score_quality(edge, none).collect()} == {0.5}


def test_held_out_labels_do_not_vote(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = in_fold("doc_id", 4, 2)
    spoilt = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.score_quality(docs, x, allowed=~held).select("doc_id", "score").orderBy("doc_id").collect() for x in (labels, spoilt))
    assert one == two


def test_the_cap_on_labelled_rows_moves_no_decision(spark):
    """Every labelled row four times over, under other ids: the cap then cuts the good ones only, later both."""
    good = [f"the harbour master wrote letter {n} about tides and boats" for n in range(24)]
    poor = [f"click here win {n} free free prizes now now" for n in range(6)]
    once = [(t, int(t in good)) for t in good + poor]
    asked = [(-1, None), (-2, ""), (-3, "letter about free boats now"), (-4, good[3]), (-5, poor[2]), (-6, "zzz qqq")]
    scores = []
    for times in (1, 4):
        rows = [(n, t, y) for n, (t, y) in enumerate(once * times)]
        docs = spark.createDataFrame([r[:2] for r in rows] + asked, "doc_id long, text string")
        labels = spark.createDataFrame([(n, y) for n, _, y in rows], "doc_id long, quality int")
        found = quality.score_quality(docs, labels, per_label=12).filter("doc_id < 0").collect()
        scores.append({r.doc_id: r.score for r in found})
    assert abs(scores[0][-1] - 0.8) < 1e-9 and abs(scores[1][-1] - 0.8) < 1e-9
    assert {n: s >= quality.THRESHOLD for n, s in scores[0].items()} == {n: s >= quality.THRESHOLD for n, s in scores[1].items()}
