"""Ranked lexical search by pipelined term partitioning.

Documents are cut into shards, items into bundles. The terms belong to owners, rare ones to the first. A
bundle carries a sparse accumulator of document scores per shard and item through the owners'
stages; each stage is a cogroup of the accumulators with the postings of its owner's terms,
and adds their integer contributions. The last one selects.

Accumulators that cannot reach a shard's k best any more are dropped on the way. That loses nothing: k
documents of the shard already score more than such a document can still reach.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, stored

# A term is a longest run of anything but the ASCII signs that are no letter or digit.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR_PATTERN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SCALE = 1_000_000_000

#: A term belongs to the first owner whose share of the documents its own does not reach; the last owns the rest.
OWNER_SHARES = (1 / 64, 1 / 8)
#: Items of a bundle, on average.
BUNDLE = 256
#: Terms of all items are sent to every task up to so many, of so many characters in all; beyond that they are joined.
SENT_TERMS, SENT_CHARS = 200_000, 16_000_000
#: Texts are cut into terms by so many characters at a time.
PIECE = 1 << 20

INDEX = "shard long, term string, docs binary, counts binary, held long, total long, ids array<long>"
ACCUMULATORS = "shard long, bundle int, item_id {item}, docs binary, scores binary"


def term_counts(text: str) -> tuple[int, Counter]:
    """How many terms a lower-cased text has, and how often each of them occurs."""
    term, separator = re.compile(TERM_PATTERN), re.compile(SEPARATOR_PATTERN)
    start, n, counts = 0, 0, Counter()
    while start < len(text):
        cut = separator.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        found = term.findall(text, start, end)
        n += len(found)
        counts.update(found)
        start = end
    return n, counts


def index(docs: DataFrame, wanted=None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The inverted index of every shard, a shard being a batch of rows that one task reads.

    A row with a term holds its documents, numbered within the shard, and how often each has it. The row
    without one holds all documents of the shard: ids, terms, how many have any and the sum.
    ``wanted``, a broadcast set, leaves out the postings of other terms.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.translate(F.coalesce(F.col(text_column).cast("string"), F.lit("")), UPPER, LOWER).alias("text"),
    )
    names = ["shard", "term", "docs", "counts", "held", "total", "ids"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        only = wanted.value if wanted is not None else None
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            sizes, postings = np.zeros(batch.num_rows, np.int64), {}
            for at, text in enumerate(batch.column(1)):
                sizes[at], counts = term_counts(text.as_py())
                for term in counts.keys() & only if only is not None else counts:
                    held = postings.setdefault(term, ([], []))
                    held[0].append(at)
                    held[1].append(counts[term])
            shard = (task << 32) + number
            out = [
                [shard] * (len(postings) + 1),
                [None, *postings],
                [None, *(np.array(d, np.int32).tobytes() for d, _ in postings.values())],
                [sizes.tobytes(), *(np.array(c, np.int64).tobytes() for _, c in postings.values())],
                [int((sizes > 0).sum()), *(len(d) for d, _ in postings.values())],
                [int(sizes.sum()), *([None] * len(postings))],
                [batch.column(0).to_pylist(), *([None] * len(postings))],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, INDEX)


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, term, times): the terms of every item; rows of one id are one item."""
    text = F.translate(F.col(text_column).cast("string"), UPPER, LOWER)
    terms = F.regexp_extract_all(text, F.lit(f"({TERM_PATTERN})"), F.lit(1))
    unfolded = items.select(F.col(id_column).alias("item_id"), F.explode(terms).alias("term"))
    return unfolded.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _sent(terms: DataFrame):
    """The different terms of all items as a broadcast set, or None where they are too many to send."""
    spark, different = terms.sparkSession, terms.select("term").distinct()
    size = different.agg(F.count(F.lit(1)), F.sum(F.length("term"))).first()
    if size[0] > SENT_TERMS or (size[1] or 0) > SENT_CHARS:
        return None
    return spark.sparkContext.broadcast(frozenset(r.term for r in different.collect()))


def rank(
    docs: DataFrame, items: DataFrame, *, k: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each item, above 0.

    Every row of ``docs`` is a document, repeated ones and those without an id included; equal scores
    follow ascending doc_id, nulls last. Rows of ``items`` that share an id, or have none, are one item whose terms
    count together. Null and empty texts have no terms; an item without terms, and any item over
    an empty table, has no rows. Extra columns are not read.

    ``docs`` is read once; the index holds the postings of the items' terms only, and is stored. All
    that follows is keyed by shard and bundle: a shard holds at most as many documents as an Arrow
    batch, a bundle some BUNDLE items, so a term that every document has is spread over all shards.
    """
    item_type = items.schema[item_column].dataType
    terms = stored(item_terms(items, item_column), "item-terms")
    built = stored(index(docs, _sent(terms), id_column, text_column), "postings")
    corpus = built.filter("term IS NULL").agg(F.sum("held"), F.sum("total")).first()
    documents, length = corpus[0] or 0, corpus[1] or 0
    n_items = terms.select(F.count_distinct(F.struct("item_id"))).first()[0]
    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    if not documents or not n_items:
        return docs.sparkSession.createDataFrame([], schema)
    asked = stored(_asked(terms, built, documents, -(-n_items // BUNDLE)), "asked")

    owners = len(OWNER_SHARES) + 1
    accumulators = ACCUMULATORS.format(item=item_type.simpleString())
    carried = docs.sparkSession.createDataFrame([], accumulators)
    for owner in range(owners):
        last = owner == owners - 1
        step = _stage(documents, length, k, last)
        out = f"item_id {item_type.simpleString()}, doc_id long, score long" if last else accumulators
        bundles, postings = carried.groupBy("shard", "bundle"), _postings(built, asked, owner).groupBy("shard", "bundle")
        carried = bundles.cogroup(postings).applyInArrow(step, out)
        if not last:
            carried = stored(carried, f"accumulators-{owner}")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = carried.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _asked(terms: DataFrame, built: DataFrame, documents: int, bundles: int) -> DataFrame:
    """Per bundle and term its weight, its owner, and the items that ask for it.

    ``rest`` bounds what the terms of later owners can add to a document's score for the item. Terms of weight 0 add nothing and are left out.
    """
    found = built.filter("term IS NOT NULL").groupBy("term").agg(F.sum("held").alias("df"))
    share = F.col("df") / F.lit(documents)
    owner = F.lit(len(OWNER_SHARES))
    for n, limit in reversed(list(enumerate(OWNER_SHARES))):
        owner = F.when(share < limit, n).otherwise(owner)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weighed = terms.join(found.select("term", owner.alias("owner"), weight.alias("weight")), "term").filter("weight > 0")
    weighed = weighed.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("int"))
    # A contribution is less than SCALE / 1000 times its weight, whatever the document.
    bound = F.sum(F.col("weight") * F.col("times") * F.lit(SCALE // 1000))
    by_owner = weighed.groupBy("item_id", "owner").agg(bound.alias("bound"))
    later = by_owner.select(F.col("item_id").alias("i"), F.col("owner").alias("o"), F.col("bound").alias("b"))
    met = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("o") > F.col("owner"))
    rest = by_owner.join(later, met, "left").groupBy("item_id", "owner").agg(F.coalesce(F.sum("b"), F.lit(0)).alias("rest"))
    rest = rest.select(F.col("item_id").alias("i"), F.col("owner").alias("o"), "rest")
    met = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("owner") == F.col("o"))
    return weighed.join(rest, met).groupBy("bundle", "term", "owner", "weight").agg(
        F.collect_list(F.struct("item_id", "times", "rest")).alias("asks")
    )


def _postings(built: DataFrame, asked: DataFrame, owner: int) -> DataFrame:
    """What an owner holds, per shard and bundle: its postings and, without a term, the shard's documents."""
    own = asked.filter(F.col("owner") == owner)
    met = built.filter("term IS NOT NULL").join(own, "term").select("shard", "bundle", "weight", "docs", "counts", "asks", "ids")
    kind = dict(met.dtypes)["asks"]
    # The queries, in blocks, against all documents: a shard's documents are needed once per bundle.
    bundles = asked.select("bundle").distinct().agg(F.sort_array(F.collect_set("bundle")).alias("b"))
    whole = built.filter("term IS NULL").withColumn("bundle", F.explode(bundles.select("b").scalar()))
    whole = whole.select("shard", "bundle", F.lit(None).cast("long").alias("weight"), "docs", "counts", F.lit(None).cast(kind).alias("asks"), "ids")
    return met.unionByName(whole)


def _stage(documents: int, length: int, k: int, last: bool):
    """The work of an owner on one shard and bundle: add its contributions to the accumulators."""

    def run(key: tuple, carried: pa.Table, postings: pa.Table) -> pa.Table:
        shard, bundle = (v.as_py() for v in key)
        whole = postings.filter(pa.compute.is_null(postings["weight"]))
        size, ids = np.frombuffer(whole["counts"][0].as_py(), np.int64), whole["ids"][0]
        m = 25 + (75 * size * documents) // length
        scores, rests = {}, {}
        for item, docs, score in zip(carried["item_id"].to_pylist(), carried["docs"].to_pylist(), carried["scores"].to_pylist(), strict=True):
            scores[item] = np.zeros(len(size), np.int64)
            scores[item][np.frombuffer(docs, np.int32)] = np.frombuffer(score, np.int64)
        for row in range(postings.num_rows):
            weight = postings["weight"][row].as_py()
            if weight is None:
                continue
            docs = np.frombuffer(postings["docs"][row].as_py(), np.int32)
            times = np.frombuffer(postings["counts"][row].as_py(), np.int64)
            gain = weight * ((SCALE * times) // (1000 * times + 8 * m[docs]))
            for ask in postings["asks"][row].as_py():
                item = ask["item_id"]
                if item not in scores:
                    scores[item] = np.zeros(len(size), np.int64)
                scores[item][docs] += ask["times"] * gain
                rests[item] = ask["rest"]
        found = []
        for item, score in scores.items():
            held = np.flatnonzero(score)
            if len(held) > k:
                kth = np.partition(score[held], -k)[-k]
                # Items that this owner has no term for keep what they carry: their rest is not known here.
                room = 0 if last else rests.get(item)
                held = held if room is None else held[score[held] + room >= kth]
            if len(held):
                found.append((item, held, score[held]))
        if not last:
            columns = [
                pa.array([shard] * len(found), pa.int64()), pa.array([bundle] * len(found), pa.int32()),
                pa.array([f[0] for f in found], carried["item_id"].type),
                pa.array([f[1].astype(np.int32).tobytes() for f in found], pa.binary()),
                pa.array([f[2].tobytes() for f in found], pa.binary()),
            ]
            return pa.Table.from_arrays(columns, names=["shard", "bundle", "item_id", "docs", "scores"])
        named = ids.values
        absent = np.asarray(named.is_null().to_numpy(zero_copy_only=False), bool)
        number = named.fill_null(0).to_numpy()
        out = []
        for item, held, score in found:
            best = np.lexsort((number[held], absent[held], -score))[:k]
            out += [(item, None if absent[d] else int(number[d]), int(s)) for d, s in zip(held[best], score[best], strict=True)]
        columns = [pa.array([o[n] for o in out], t) for n, t in enumerate((carried["item_id"].type, pa.int64(), pa.int64()))]
        return pa.Table.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return run
