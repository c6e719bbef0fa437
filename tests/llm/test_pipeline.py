"""The pipeline: what each stage keeps, on its own input, and the records at the end."""

import json

import corpus_pipeline
from test_decontam import brute
from test_simhash import groups, plain_fingerprint
from test_tokenids import expected

from tallybridge.llm import mixing, quality, queries
from tallybridge.llm.common import in_fold, stored
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


def rows(frame):
    return [tuple(r) for r in frame.select(COLUMNS).collect()]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near copies", "benchmark", "mixing", "token records"]
    before, out = docs, []
    for _, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF), "test-stage")
        out.append((before, after))
        before = after
    for _, after in out[:-1]:
        assert after.columns == docs.columns

    given, kept = (rows(f) for f in out[0])
    score = quality.score_quality(docs, labels, allowed=~in_fold("doc_id", 4, 2)).filter("score >= 0.7")
    assert sorted(kept, key=str) == sorted(rows(score), key=str) and len(kept) < len(given)

    given, kept = (sorted(rows(f)) for f in out[1])
    first = groups([plain_fingerprint(r[1]) for r in given], 2).tolist()
    assert kept == [r for n, r in enumerate(given) if first[n] == n] and len(kept) < len(given)

    given, kept = (sorted(rows(f)) for f in out[2])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute({r[0]: r[1] for r in given}, items, 10)
    assert kept == [r for r in given if not hit[r[0]][4]] and len(kept) < len(given)

    given, kept = (rows(f) for f in out[3])
    rates = mixing.mix_rates(out[3][0], labels, queries.TARGETS, domain=queries.domain())
    times = {r.doc_id: r.c for r in rates.withColumn("c", mixing.copies(F.col("rate"), 1, "doc_id", "row_hash")).collect()}
    assert sorted(kept, key=str) == sorted([r for r in given for _ in range(times[r[0]])], key=str)

    records = out[4][1].orderBy("start").collect()
    assert [r.doc_id for r in records] == sorted(r[0] for r in kept)
    length = {r[0]: len(expected(r[1])) + 1 for r in kept}
    start = 0
    for r in records:
        assert (r.start, r.n_tokens) == (start, length[r.doc_id])
        start += r.n_tokens
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, records))


def test_odd_rows_pass_every_stage(spark, edge, nothing):
    docs = edge.select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, nothing.select(*COLUMNS), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    kept = corpus_pipeline.one_of_near_copies(spark, docs, SF)
    assert json.dumps(sorted(str(r.doc_id) for r in kept.collect())) == json.dumps(["1", "3", "6", "7", "8", "9", "None"])
    clean = corpus_pipeline.without_benchmark(spark, docs, SF)
    assert clean.count() == docs.count()
