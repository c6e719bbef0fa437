"""Near copies by 64-bit fingerprints of word shingles, found with pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, clear_of, row_hash, stored
from .components import connected_components

SEED = 42
PIVOTS = 16
# Fingerprints that one task compares pair by pair; a larger block is linked by shared neighbours.
BLOCK_ROWS = 512
# Shingles counted at a time, so that a very long text needs no more memory than a short one.
COUNTED = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit b is set where it is set in over half of the XXH64 (seed 42) of all shingles.

    A-Z become lower case; words are runs without blank, tab, LF, VT, FF, CR; a shingle is
    ``shingle`` words joined by one blank, repeats counted. A text of fewer words is one
    shingle, a null text or one without words has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    ends = ends[shingle - 1 :]
    for at in range(0, len(starts), COUNTED):
        s, e = starts[at : at + COUNTED].tolist(), ends[at : at + COUNTED].tolist()
        hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(s, e, strict=True)), np.uint64, len(s))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(starts), bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text_column: str, shingle: int, keep: list[Column]) -> DataFrame:
    """``keep`` and the signed 64-bit ``fp`` of every row; the text goes no further."""
    rows = docs.select(*keep, F.col(text_column).cast("string").alias("__text"))
    schema = rows.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        names = batch.schema.names
        columns = {n: batch.column(i) for i, n in enumerate(names[:-1])}
        prints = [fingerprint(t.as_py(), shingle) for t in batch.column(len(names) - 1)]
        yield columns | {"fp": pa.array(np.array(prints, np.uint64).view(np.int64))}

    return by_batch(rows, schema, run)


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, signed: XXH64 of their number."""
    values = np.array([xxhash.xxh64_intdigest(f"pivot {n}", SEED) for n in range(count)], np.uint64)
    return values.view(np.int64).tolist()


def distance_table(prints: DataFrame) -> DataFrame:
    """Adds the Hamming distances to all pivots, a byte each, eight to a long: ``c0``, ``c1``."""
    packed = []
    for at in range(0, PIVOTS, 8):
        parts = [
            F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * n)
            for n, p in enumerate(pivots()[at : at + 8])
        ]
        column = parts[0]
        for part in parts[1:]:
            column = column.bitwiseOR(part)
        packed.append(column.alias(f"c{at // 8}"))
    return prints.select("*", *packed)


def linked(prints: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of one block that leave out what the pivots or the fingerprints tell apart.

    A pair whose distances to some pivot differ by more than ``max_bits`` cannot be that
    close (triangle inequality) and is discarded; survivors are verified bit by bit. Only
    one link from each row to the smallest verified partner chain is needed, so a row that is
    already in a group is linked once.
    """
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    last = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    group = np.arange(len(prints))
    out = []
    for i in range(len(prints) - 1):
        near = np.arange(i + 1, last[i])
        near = near[group[near] != group[i]]
        if not len(near):
            continue
        near = near[np.abs(table[near] - table[i]).max(1) <= max_bits]
        near = near[np.bitwise_count((prints[near] ^ prints[i]).view(np.uint64)) <= max_bits]  # of signed numbers it counts the absolute value
        for j in near.tolist():
            if group[j] != group[i]:
                out.append((int(prints[i]), int(prints[j])))
                group[group == group[j]] = group[i]
    return out


def _link_blocks(blocks: DataFrame, max_bits: int) -> DataFrame:
    """Rows with a bounded list ``members`` of (fp, c0, c1) to links (a, b)."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = batch.column(0)
        ends = lists.offsets.to_numpy()
        members = lists.values
        prints, *coordinates = (members.field(n).to_numpy(zero_copy_only=False) for n in range(3))
        table = np.stack(coordinates, 1).view(np.uint8).astype(np.int16)
        a, b = [], []
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            for x, y in linked(prints[start:end], table[start:end], max_bits):
                a.append(x)
                b.append(y)
        yield {"a": a, "b": b}

    return by_batch(blocks.select("members"), "a long, b long", run)


def block_keys(max_bits: int) -> Column:
    """Of ``max_bits`` + 2 blocks of a fingerprint, two agree in any pair of linked ones: one
    key for each pair of blocks."""
    count = max_bits + 2
    cuts = [64 * n // count for n in range(count + 1)]
    masks = [sum(1 << bit for bit in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    keys = []
    for n, (x, y) in enumerate(combinations(masks, 2)):
        mask = int(np.array([x | y], np.uint64).view(np.int64)[0])
        keys.append(F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("k")))
    return F.array(*keys)


def neighbour_keys(radius: int) -> Column:
    """The fingerprint itself and all that differ in up to ``radius`` bits."""
    flips = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    signed = np.array(flips, np.uint64).view(np.int64).tolist()
    return F.transform(F.array(*[F.lit(x) for x in signed]), lambda x: x.bitwiseXOR(F.col("fp")))


def links_within(prints: DataFrame, max_bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``max_bits``.

    Two that are that close share one of the block keys. Blocks of up to ``block_rows`` are
    compared in one task each. A larger block, as thousands of near copies make, is not:
    its members emit every fingerprint within half the distance, and two members are close
    just if they share one. Such a group has at most as many members as a fingerprint has
    neighbours, whatever the number of copies.
    """
    keyed = stored(distance_table(prints.select("fp").distinct()), "pivot-table")
    member = F.struct("fp", "c0", "c1")
    rows = keyed.select("fp", "c0", "c1", F.explode(block_keys(max_bits)).alias("key"))
    shared = stored(rows.groupBy("key").count().filter("count > 1"), "blocks")
    small = rows.join(shared.filter(F.col("count") <= block_rows), "key")
    blocks = small.groupBy("key").agg(F.collect_list(member).alias("members"))
    hot = rows.join(shared.filter(F.col("count") > block_rows), "key", "left_semi").select("fp", "c0", "c1").distinct()
    near = hot.select("fp", "c0", "c1", F.explode(neighbour_keys((max_bits + 1) // 2)).alias("key"))
    around = near.groupBy("key").agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)
    return _link_blocks(blocks.select("members").union(around.select("members")), max_bits)


def near_copies(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Every row's doc_id, row_hash, fp and component_id, the smallest id reachable by links.

    Fingerprints link at ``max_bits`` or fewer differing bits; equal ones, those of null and
    empty texts included, are one node. A null id takes part but is nobody's smallest id
    (component_id is null only where no member has one). Repeated rows stay repeated.
    ``row_hash`` covers all columns and tells rows of one id apart. An empty table gives an
    empty result. Extra columns are not read beyond that hash.
    """
    own = [F.col(id_column).cast("long").alias("doc_id"), row_hash(docs).alias("row_hash")]
    rows = stored(with_fingerprint(docs, text_column, shingle, own), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    parts = connected_components(links_within(nodes, max_bits))
    placed = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    placed = stored(placed, "placed")
    # Written before the join, so that adaptive execution can split a component with many prints.
    smallest = stored(placed.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    labels = placed.join(smallest, "component").select("fp", "component", "component_id")
    return rows.join(labels, "fp").select("doc_id", "row_hash", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: of every group the one with the smallest id (a null id
    last, then the smallest row hash), once, with all its columns."""
    found = stored(near_copies(docs, **options), "near-copies")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_hash")
    chosen = stored(
        found.groupBy("component").agg(F.min(rank).alias("r")).select("r.doc_id", "r.row_hash"), "kept"
    )
    repeated = found.groupBy("doc_id", "row_hash").count().filter("count > 1")
    id_name, hash_name, row_name = (clear_of(docs, f"kept_{part}") for part in ("id", "hash", "row"))
    id_column = options.get("id_column", "doc_id")
    hashed = docs.withColumn(hash_name, row_hash(docs))
    chosen = chosen.select(F.col("doc_id").alias(id_name), F.col("row_hash").alias(row_name))
    same = F.col(id_column).cast("long").eqNullSafe(F.col(id_name)) & (F.col(hash_name) == F.col(row_name))
    kept = hashed.join(chosen, same, "left_semi")
    if not repeated.isEmpty():  # rows that are equal throughout: one of them
        kept = kept.dropDuplicates([id_column, hash_name])
    return kept.drop(hash_name)
