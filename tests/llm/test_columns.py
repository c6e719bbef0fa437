"""Columns of any name and type beside the documents: no operator or stage fails, and rows keep them."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybridge.llm import decontam, language, mixing, pii, quality, queries, ranked, secrets, simhash, suffix
from tallybridge.llm.common import row_hash

SF = "/root/testdata/sf0.001"
ODD = ["meta.lang", "a`b", "mixed_hashd", "mixed_row", "kept_hashr", "kept_row", "kept_id_"]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    more = [F.lit(f"{n}").alias(n) for n in ODD]
    docs = docs.select("*", *more, F.create_map(F.lit("k"), F.col("doc_id") % 2).alias("map"), F.array(F.create_map(F.lit(1), F.col("source"))).alias("maps"))
    return docs.unionByName(docs.filter("doc_id < 3"))


def own(frame):
    return {(r["doc_id"], *(r[n] for n in ODD), r["map"]["k"], r["maps"][0][1] == r["source"]) for r in frame.collect()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_them(spark, odd, name, stage):
    after = stage(spark, odd, SF)
    assert after.columns == odd.columns
    kept = own(after)
    assert kept and kept <= {(n, *ODD, n % 2, True) for n in range(300)}


def test_rows_that_differ_in_a_map_only_stay_apart(spark, odd):
    one, two = odd.filter("doc_id = 7"), odd.filter("doc_id = 7").withColumn("map", F.create_map(F.lit("k"), F.lit(5).cast("long")))
    hashes = [r[0] for r in one.union(one).union(two).select(row_hash(odd)).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_operators_take_them(spark, odd):
    labels, benchmark = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("labels", "benchmark"))
    plain = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    plain = plain.unionByName(plain.filter("doc_id < 3"))
    count = odd.count()
    whole = [
        lambda d: mixing.mix_rates(d, labels, queries.TARGETS, domain=queries.domain()),
        simhash.near_copies, secrets.find_secrets,
        lambda d: language.identify(d, language.learn(d)),
        lambda d: quality.score_quality(d, labels),
        lambda d: decontam.contamination(d, benchmark),
        lambda d: pii.pseudonymise(d, b"key"),
        lambda d: suffix.remove_repeats(d, min_bytes=100),
    ]
    for operator in whole:
        assert operator(odd).count() == count
    assert own(pii.pseudonymise(odd, b"key")) == own(quality.score_quality(odd, labels)) == own(odd)
    ranks = [sorted(map(tuple, ranked.rank(d, benchmark, k=3).collect())) for d in (odd, plain)]
    assert ranks[0] == ranks[1]
    assert queries.token_records(spark, odd).count() == count
