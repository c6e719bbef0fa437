"""Quality scores by nearest-neighbour voting among labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Sent, by_batch, clear_of, stored
from .features import chunks, shape_hashes, spread, word_hashes

WORD_BITS, SHAPE_BITS, REPEAT_BINS = 11, 10, 8
WIDTH = (1 << WORD_BITS) + (1 << SHAPE_BITS) + REPEAT_BINS
# The labelled rows that fit the space and vote: at most this many of each label.
PER_LABEL = 2048
DIMENSIONS = 48
NEIGHBOURS = 31
SHARPNESS = 8.0
THRESHOLD = 0.7


def term_rows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, term matrix): square roots of term shares, by family."""
    words_to, shapes_to = 1 << WORD_BITS, (1 << WORD_BITS) + (1 << SHAPE_BITS)
    for first, last, pieces in chunks(column):
        n = last - first
        counts = np.zeros((n, WIDTH), np.float32)
        total, seen = np.zeros(n), []
        for data, offsets in pieces:
            row, word = word_hashes(data, offsets)
            counts[:, :words_to] += _counted(row, spread(word, WORD_BITS), n, words_to)
            total += np.bincount(row, minlength=n)
            seen.append(np.unique((row.astype(np.uint64) << np.uint64(40)) | spread(word, 40)))
            row, shape = shape_hashes(data, offsets)
            counts[:, words_to:shapes_to] += _counted(row, spread(shape, SHAPE_BITS), n, shapes_to - words_to)
        for family in (slice(0, words_to), slice(words_to, shapes_to)):
            part = counts[:, family]
            part /= np.maximum(part.sum(1, keepdims=True), 1)
        np.sqrt(counts, out=counts)
        # A word counts once per text, however many pieces a long text is taken in.
        words = np.unique(np.concatenate(seen)) if seen else np.empty(0, np.uint64)
        distinct = np.bincount((words >> np.uint64(40)).astype(np.int64), minlength=n)
        share = distinct / np.maximum(total, 1)
        bins = np.minimum((share * REPEAT_BINS).astype(int), REPEAT_BINS - 1)
        counts[np.arange(n), shapes_to + bins] = (total >= 20) * 0.5
        yield first, last, counts


def _counted(row: np.ndarray, bucket: np.ndarray, rows: int, width: int) -> np.ndarray:
    return np.bincount(row * width + bucket.astype(np.int64), minlength=rows * width).reshape(rows, width)


class Space:
    """Term weights and the leading right singular vectors of the labelled sample's term matrix.

    Each row counts by its ``weight``; the weights have a mean of 1.
    """

    def __init__(self, terms: np.ndarray, weight: np.ndarray, dimensions: int):
        present = weight @ (terms > 0)
        self.weights = np.log((1 + len(terms)) / (1 + present)).astype(np.float32) + 0.1
        weighted = terms * self.weights
        weighted *= np.sqrt(weight)[:, None] / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
        k = min(dimensions, *terms.shape)
        basis = np.random.default_rng(0).standard_normal((terms.shape[1], k + 16)).astype(np.float32)
        for _ in range(4):  # subspace iteration
            basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
        _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
        self.axes = (self.weights[:, None] * (basis @ right.T[:, :k])).astype(np.float32)

    def vectors(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors; a text without terms is the zero vector."""
        out = terms @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, *, label: Column, allowed: Column, id_column: str, text_column: str, per_label: int
) -> DataFrame:
    """(doc_id, y, text, weight) of up to ``per_label`` rows of each label, drawn by a hash of the id.

    ``weight`` is how many different labelled rows each drawn one stands for, so that the labels'
    shares do not depend on which of them ``per_label`` cuts. Only labelled rows whose document is
    in ``docs`` are counted and drawn. Rows whose label or id is null, or that ``allowed`` (over ``doc_id``) excludes, are left out.
    """
    rows = labels.select(F.col(id_column).cast("long").alias("doc_id"), label.alias("y")).dropna().filter(allowed).distinct()
    here = docs.select(F.col(id_column).cast("long").alias("doc_id")).dropna().distinct()
    rows = stored(rows.join(here, "doc_id", "left_semi"), "labelled")
    drawn = F.xxhash64("doc_id", F.lit(7))
    counts = [(r.y, r["count"]) for r in rows.groupBy("y").count().orderBy("y").collect()]
    parts = [
        rows.filter(F.col("y") == v).orderBy(drawn, "doc_id").limit(per_label).withColumn("weight", F.lit(n / min(n, per_label)))
        for v, n in counts
    ]
    sample = parts[0] if parts else rows.limit(0).withColumn("weight", F.lit(1.0))
    for part in parts[1:]:
        sample = sample.union(part)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    # The sample holds at most per_label narrow rows of each label, whatever the input.
    drawn = texts.join(F.broadcast(sample), "doc_id")
    # Of an id with several texts the one with the smallest hash, so the bound holds whatever is repeated.
    return drawn.groupBy("doc_id", "y", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "y", "text", "weight")


def fit(sample: DataFrame, dimensions: int = DIMENSIONS) -> tuple[Space, np.ndarray, np.ndarray, np.ndarray, float]:
    """The space, the labelled unit vectors, their labels and weights, and the weighted share of label 1."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, last, terms in term_rows(batch.column(2)):
            row, term = np.nonzero(terms)
            cuts = np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)
            yield {
                "doc_id": batch.column(0)[first:last],
                "y": batch.column(1)[first:last],
                "weight": batch.column(3)[first:last],
                "term": pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                "share": pa.ListArray.from_arrays(cuts, pa.array(terms[row, term])),
            }

    found = by_batch(sample, "doc_id long, y int, weight double, term array<int>, share array<float>", run).toArrow()
    found = found.combine_chunks().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    terms = np.zeros((len(found), WIDTH), np.float32)
    for n, (term, share) in enumerate(zip(found["term"], found["share"], strict=True)):
        terms[n, term.values.to_numpy()] = share.values.to_numpy()
    y = found["y"].to_numpy().astype(np.float32)
    if not len(y):
        return None, np.zeros((0, 1), np.float32), y, y, 0.5
    weight = found["weight"].to_numpy()
    weight = weight / weight.mean()
    space = Space(terms, weight.astype(np.float32), dimensions)
    return space, space.vectors(terms), y, weight, float(np.average(y, weights=weight))


def votes(vectors: np.ndarray, labelled: np.ndarray, y: np.ndarray, prior: float, stands_for: np.ndarray | None = None) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity and by how
    many labelled rows each one stands for (``stands_for``, 1 if not given).

    The cosine with every labelled vector is computed; ``prior`` counts as a faint vote, so
    a document without similar ones, an empty text for one, scores ``prior``.
    """
    cosine = vectors @ labelled.T
    k = min(NEIGHBOURS, labelled.shape[0])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
    if stands_for is not None:
        weight *= stands_for[near]
    faint = 1e-6
    return ((weight * y[near]).sum(1) + faint * prior) / (weight.sum(1) + faint)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    allowed: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    per_label: int = PER_LABEL,
    score_column: str = "score",
) -> DataFrame:
    """``docs`` with a score from 0 to 1, higher where label 1 is likelier.

    The space and the voters come from at most ``per_label`` labelled rows of each label; their
    vectors (a few MB by that bound) are sent to every task, and each document is compared
    with all of them, a block of rows at a time. A voter counts as often as the labelled rows
    it stands for; labels other than 0 and 1 count for nothing. Null and empty texts get the share of label 1 among all allowed labelled
    rows, all documents 0.5 if nothing is labelled. Rows keep all their columns,
    repeated rows stay repeated, an empty table stays empty.
    """
    marked = F.col(label_column).cast("int")
    sample = labelled_sample(
        docs, labels, label=F.when(marked.isin(0, 1), marked), allowed=F.lit(True) if allowed is None else allowed,
        id_column=id_column, text_column=text_column, per_label=per_label,
    )
    model = Sent(docs.sparkSession, fit(sample))
    schema = T.StructType([*docs.schema.fields, T.StructField(clear_of(docs, score_column), T.DoubleType())])
    at = docs.columns.index(text_column)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        space, labelled, y, stands_for, prior = model.value
        texts = batch.column(at).cast(pa.string())
        score = np.full(batch.num_rows, prior, np.float64)
        if space is not None:
            for first, last, terms in term_rows(texts):
                score[first:last] = votes(space.vectors(terms), labelled, y, prior, stands_for)
        yield {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {schema.names[-1]: pa.array(score)}

    return by_batch(docs, schema, run)
