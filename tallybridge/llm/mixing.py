"""Mixing documents to target weights by soft domain membership.

A classifier fitted on labelled rows predicts for every document how far it belongs to each
domain. Nonnegative rates r then minimise, by distributed projected gradient steps, the
squared distance between the expected domain tokens, the sum of r * tokens * posterior, and
the targets, each domain's square divided by the tokens it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Sent, all_columns, by_batch, clear_of, row_hash, stored
from .features import chunks, shape_hashes, spread, word_hashes
from .quality import labelled_sample

WORD_BITS, SHAPE_BITS = 15, 9
WIDTH = (1 << WORD_BITS) + (1 << SHAPE_BITS)
# Labelled rows that the classifier is fitted on: at most this many of each domain.
PER_DOMAIN = 2048
FIT_STEPS = 120
# Standard deviations from chance that a term's count in a domain must be off to be weighed.
TELLING = 4.0
MAX_STEPS = 40
STORED_STEPS = 8
TOLERANCE = 5e-4
STILL = 0.01


def token_terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, words of each row, rows, terms): the distinct hashed
    words of each row, and every kind of three neighbouring signs that makes up 1% of it."""
    for first, last, pieces in chunks(column):
        n = last - first
        tokens, found = np.zeros(n, np.int64), []
        shapes = np.zeros((n, 1 << SHAPE_BITS))
        for data, offsets in pieces:
            row, word = word_hashes(data, offsets)
            tokens += np.bincount(row, minlength=n)
            found.append(np.unique(row * WIDTH + spread(word, WORD_BITS).astype(np.int64)))
            row, shape = shape_hashes(data, offsets)
            at = row * shapes.shape[1] + spread(shape, SHAPE_BITS).astype(np.int64)
            shapes += np.bincount(at, minlength=shapes.size).reshape(shapes.shape)
        common = shapes > np.maximum(0.01 * shapes.sum(1, keepdims=True), 0)
        row, shape = np.nonzero(common)
        found.append(row * WIDTH + (1 << WORD_BITS) + shape)
        keys = np.unique(np.concatenate(found))
        yield first, last, tokens, keys // WIDTH, keys % WIDTH


class Classifier:
    """Softmax regression on the terms present in a text.

    ``stands_for`` says by class how many labelled rows a row of the sample stands for; the bias is
    moved by it, from the classes' shares in the sample to those among all labelled rows.
    """

    def __init__(self, rows: np.ndarray, terms: np.ndarray, y: np.ndarray, classes: int, stands_for: np.ndarray, steps: int = FIT_STEPS):
        share = np.bincount(y, minlength=classes) / max(len(y), 1)
        self.weights, self.bias = np.zeros((WIDTH, classes)), np.log(np.maximum(share, 1e-6))
        truth = np.eye(classes)[y]
        # Only terms that some domain has far more or less often than chance are weighed.
        seen = np.stack([np.bincount(terms, truth[rows, c], WIDTH) for c in range(classes)], 1).astype(float)
        due = seen.sum(1, keepdims=True) * share
        telling = (np.abs(seen - due) / np.sqrt(due * (1 - share) + 0.5)).max(1) > TELLING
        rows, terms = rows[telling[terms]], terms[telling[terms]]
        mean, square = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for step in range(1, steps + 1):
            error = (self.posteriors(rows, terms, len(y)) - truth) / max(len(y), 1)
            gradient = np.stack([np.bincount(terms, error[rows, c], WIDTH) for c in range(classes)], 1) + 1e-5 * self.weights
            mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
            self.weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
            self.bias -= 0.5 * error.sum(0)
        self.bias += np.log(stands_for)

    def posteriors(self, rows: np.ndarray, terms: np.ndarray, count: int) -> np.ndarray:
        scores = np.stack([np.bincount(rows, self.weights[terms, c], count) for c in range(len(self.bias))], 1) + self.bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)


def fit(sample: DataFrame, domains: list[str]) -> Classifier:
    """The classifier of a bounded sample (doc_id, y, text, weight); without rows all domains are alike."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, last, _, row, term in token_terms(batch.column(2)):
            cuts = np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)
            yield {
                "doc_id": batch.column(0)[first:last],
                "y": batch.column(1)[first:last],
                "weight": batch.column(3)[first:last],
                "term": pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
            }

    found = by_batch(sample, "doc_id long, y string, weight double, term array<int>", run).toArrow()
    found = found.combine_chunks().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    lists = found["term"].combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    rows = np.repeat(np.arange(len(found)), lists.value_lengths().to_numpy().astype(np.int64))
    y = np.array([domains.index(v) for v in found["y"].to_pylist()], np.int64)
    stands_for = np.ones(len(domains))
    stands_for[y] = found["weight"].to_numpy()
    return Classifier(rows, lists.flatten().to_numpy().astype(np.int64), y, len(domains), stands_for)


def with_posteriors(docs: DataFrame, text_column: str, model, keep: list[Column]) -> DataFrame:
    """``keep``, the words of each text and the array of its domain posteriors."""
    rows = docs.select(*keep, F.col(text_column).cast("string").alias("__text"))
    schema = T.StructType(
        [*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))]
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        classifier, names = model.value, batch.schema.names
        tokens, found = np.zeros(batch.num_rows, np.int64), []
        for first, last, count, row, term in token_terms(batch.column(len(names) - 1)):
            tokens[first:last] = count
            found.append(classifier.posteriors(row, term, last - first))
        p = np.concatenate(found) if found else np.zeros((0, len(classifier.bias)))
        lists = pa.ListArray.from_arrays(np.arange(0, p.size + 1, max(p.shape[1], 1), dtype=np.int32)[: len(p) + 1], pa.array(p.ravel()))
        yield {n: batch.column(i) for i, n in enumerate(names[:-1])} | {"n_tokens": tokens, "posterior": lists}

    return by_batch(rows, schema, run)


def _advanced(members: DataFrame, path: list[tuple[list[float], float]]) -> DataFrame:
    """``rate`` and the point ``ahead`` of it after the steps of ``path``, each a move and a momentum."""
    if not path:
        return members
    p = F.col("posterior")
    steps = F.array(*[F.struct(F.array(*map(F.lit, g)).alias("g"), F.lit(m).alias("m")) for g, m in path])

    def step(state: Column, one: Column) -> Column:
        move = F.aggregate(F.zip_with(one["g"], p, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        rate = F.greatest(F.lit(0.0), state["ahead"] - move)
        return F.struct(rate.alias("rate"), (rate + one["m"] * (rate - state["rate"])).alias("ahead"))

    after = F.aggregate(steps, F.struct("rate", "ahead"), step)
    others = [c for c in members.columns if c not in ("rate", "ahead")]
    return members.withColumn("__after", after).select(*others, "__after.rate", "__after.ahead")


def fit_rates(
    members: DataFrame, targets: list[float], *, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE
) -> tuple[DataFrame, list[float]]:
    """``members`` (n_tokens, posterior) with their ``rate``, and the expected tokens per domain.

    ``targets`` are shares of all tokens. Steps start from rates of 1 and follow the gradient in
    the metric that weighs documents by their tokens: the rate becomes what is ahead of it less
    step * posterior . ((reached - target) / present share), cut at 0, so that a small domain is
    fitted as fast as a large one. The step is one over the largest eigenvalue of the moments in
    that scale, so none overshoots; momentum carries on (Nesterov), from zero again when the
    distance grows. Stops when all shares are within ``tolerance``, when steps take off less
    than STILL of the distance, or after ``max_steps``. A step is one pass that combines twice
    as many sums as there are domains in every task; every STORED_STEPS the rates are written
    down. No tokens: all rates 1.
    """
    k = len(targets)
    weight = F.col("n_tokens").cast("double")
    p = [F.col("posterior")[i] for i in range(k)]
    moments = [F.sum(weight * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]
    first = members.agg(F.sum(weight).alias("n"), *moments).first()
    members = members.withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)})
    if not first["n"]:
        return members.drop("ahead"), [0.0] * k
    total = first["n"]
    gram = np.array([[first[f"m{i}_{j}"] for j in range(k)] for i in range(k)]) / total
    # The posteriors of a document sum to one, so a row of moments sums to the domain's share.
    scale = 1.0 / np.maximum(gram.sum(1), 1e-9)
    step = 1.0 / float(np.linalg.eigvalsh(gram * np.sqrt(np.outer(scale, scale)))[-1])
    goal = np.array(targets, float)
    path: list[tuple[list[float], float]] = []
    reached, distance, age = None, np.inf, 0
    for n in range(max_steps + 1):
        at = _advanced(members, path)
        sums = at.agg(
            *[F.sum(weight * F.col("rate") * p[i]) for i in range(k)], *[F.sum(weight * F.col("ahead") * p[i]) for i in range(k)]
        ).first()
        now, ahead = np.array(sums[:k]) / total, np.array(sums[k:]) / total
        reached, before, distance = now, distance, float((scale * (now - goal) ** 2).sum())
        age = 0 if distance > before else age + 1
        still = age > 4 and before - distance <= STILL * distance
        if np.abs(now - goal).max() <= tolerance or still or n == max_steps:
            break
        path.append(((step * scale * (ahead - goal)).tolist(), age / (age + 3.0)))
        if len(path) == STORED_STEPS:
            members, path = stored(_advanced(members, path), "rates"), []
    return _advanced(members, path).drop("ahead"), (reached * total).tolist()


def mix_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    *,
    domain: Column,
    budget: float = 1.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    per_domain: int = PER_DOMAIN,
) -> DataFrame:
    """Every row's doc_id, row_hash, n_tokens, posterior (in the order of ``targets``) and rate.

    ``domain`` over ``labels`` names each labelled row's domain; rows with another name or
    none are not learned from. ``targets`` weigh the domains, ``budget`` is the wanted token total as a
    multiple of the present one. Null and empty texts have no tokens; their rate follows
    from the prior posterior and moves no total. Repeated rows each get the same rate.
    ``row_hash`` covers all columns and tells rows of one id apart. Extra columns only count there.
    """
    names = list(targets)
    sample = labelled_sample(
        docs, labels.filter(domain.isin(names)), label=domain, allowed=F.lit(True),
        id_column=id_column, text_column=text_column, per_label=per_domain,
    )
    model = Sent(docs.sparkSession, fit(sample, names))  # WIDTH * domains numbers
    own = [F.col(id_column).cast("long").alias("doc_id"), row_hash(docs).alias("row_hash")]
    members = stored(with_posteriors(docs, text_column, model, own), "members")
    share = np.array(list(targets.values()), float)
    return fit_rates(members, (budget * share / share.sum()).tolist())[0]


def copies(rate: Column, seed: int, *identity: str) -> Column:
    """A whole number with mean ``rate``: its floor, and one more for as many rows as the rest says."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + drawn).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], *, seed: int = 1, **options) -> DataFrame:
    """``docs`` with each row as often as its rate says, in all its columns.

    Equal rows share a rate and a draw, so the rates are made distinct before the join and
    no row is multiplied by its repetitions.
    """
    found = mix_rates(docs, labels, targets, **options)
    times = stored(
        found.select("doc_id", "row_hash", copies(F.col("rate"), seed, "doc_id", "row_hash").alias("times"))
        .filter("times > 0")
        .distinct(),
        "times",
    )
    id_column = options.get("id_column", "doc_id")
    a, b, n, own = (clear_of(docs, f"mixed_{part}") for part in ("id", "hash", "times", "row"))
    times = times.select(F.col("doc_id").alias(a), F.col("row_hash").alias(b), F.col("times").alias(n))
    hashed = docs.withColumn(own, row_hash(docs))
    same = F.col(id_column).cast("long").eqNullSafe(F.col(a)) & (F.col(own) == F.col(b))
    out = hashed.join(times, same)
    return out.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*all_columns(docs))
