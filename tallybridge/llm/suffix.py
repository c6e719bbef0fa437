"""Removal of byte strings that occur earlier in the corpus, by suffix sorting.

Every string of ``min_bytes`` bytes is assigned to an anchor, the place inside it where the
hash of a short gram is smallest; equal strings choose equal anchors. Strings that start
next to each other and share an anchor form a segment. So only segments whose anchor gram
occurs again can hold a repeat, equal segments repeat as a whole, and what is left, different
segments around the same gram, is settled by suffix arrays over these segments.

A suffix array is built in two stages: suffixes smaller than their successor are sorted
directly, the others are put in place by one scan over the buckets of first bytes. Common
prefixes of neighbours then tell which strings are equal.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, kept, stored
from .features import BASE, SPREAD, utf8

MIN_BYTES = 100
GRAM = 24
BLOCK = 1 << 20
# Different segments around one gram that a task sorts together; where a gram has more, its
# segments are cut into single strings, which meet by a hash of all their bytes instead.
TOGETHER = 4096
POSITION = ["doc_id", "text_hash", "start"]


def release(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM has collected what refers to them. Asking for that
    between steps keeps one step's files on disk at a time rather than all."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---- suffix arrays ---------------------------------------------------------------


def _words(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from every position as one number, zeros after the end."""
    out = np.zeros(len(text) + pad, np.uint64)
    for n in range(8):
        out[: max(len(text) - n, 0)] |= text[n:].astype(np.uint64) << np.uint64(56 - 8 * n)
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a byte later; the last is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(np.diff(text.astype(np.int16)))
    changes = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(changes[::-1])[::-1]] > 0


def _sorted_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` by the ``depth`` bytes from each, eight more at a time for those still equal.

    What the end of the text leaves equal to a longer suffix of zeros stays in front of it.
    """
    if not len(at):
        return at
    at = at[::-1]
    order = np.argsort(words[at], kind="stable")
    at = at[order]
    new = np.ones(len(at), bool)
    new[1:] = words[at[1:]] != words[at[:-1]]
    for done in range(8, depth, 8):
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        part, group = at[open_], np.cumsum(new)[open_]
        key = words[part + done]
        order = np.lexsort((key, group))
        part, key, group = part[order], key[order], group[order]
        at[open_] = part
        new[open_[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return at


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``text`` in order of at least their first ``depth`` bytes.

    Stage one sorts the suffixes smaller than their successor. Stage two scans the buckets of
    first bytes in rising order: a suffix found there puts the one a byte earlier at the next
    free place of its bucket if that one is larger than its successor. In a bucket
    those come before the directly sorted ones.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    direct = _sorted_directly(_words(text, depth + 8), np.flatnonzero(smaller_than_next(text)), depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed[text[-1]].append(np.array([n - 1]))
    out = []
    for c in np.flatnonzero(np.bincount(text, minlength=256)).tolist():
        found = np.concatenate(placed[c]) if placed[c] else np.empty(0, np.int64)
        bucket = [found]
        while len(found):  # runs of one byte
            found = found[found > 0] - 1
            found = found[text[found] == c]
            bucket.append(found)
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        earlier = whole[whole > 0] - 1
        first = text[earlier]
        larger = first > c
        earlier, first = earlier[larger], first[larger]
        order = np.argsort(first, kind="stable")
        earlier, first = earlier[order], first[order]
        for piece in np.split(earlier, np.flatnonzero(np.diff(first)) + 1):
            if len(piece):
                placed[text[piece[0]]].append(piece)
        placed[c] = []
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in ``order`` shares with the one before, up to ``most``."""
    words = _words(text, most + 8)
    left = np.minimum(len(text) - order, most)
    shared = np.zeros(len(order), np.int64)
    pairs = np.arange(1, len(order))
    for done in range(0, most, 8):
        differ = words[order[pairs] + done] ^ words[order[pairs - 1] + done]
        same = differ == 0
        bits = np.frexp(differ[~same].astype(np.float64))[1]  # at most one too many, by rounding up
        wrong = (bits > 1) & ((differ[~same] >> np.minimum(np.maximum(bits - 1, 0), 63).astype(np.uint64)) == 0)
        shared[pairs[~same]] = done + (64 - (bits - wrong)) // 8
        pairs = pairs[same]
        shared[pairs] = done + 8
    limit = np.minimum(left, np.concatenate([[0], left[:-1]]))
    return np.minimum(shared, limit)


# ---- anchors ---------------------------------------------------------------------


def _powers() -> tuple[np.ndarray, np.ndarray]:
    def make():
        return tuple(np.cumprod(np.full(BLOCK + 4096, b, np.uint64)) for b in (BASE, pow(BASE, -1, 1 << 64)))

    return kept("anchor_powers", make)


def segments(
    data: np.ndarray, offsets: np.ndarray, min_bytes: int, gram: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, first start in ``data``, number of starts, gram hash) of runs of strings that share an anchor.

    Blocks overlap by ``min_bytes`` - 1 bytes, so no string is missed in a text of any length.
    """
    power, inverse = _powers()
    width, low = min_bytes - gram + 1, np.uint64((1 << 21) - 1)
    ends = offsets[1:]
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK + min_bytes - 1]
        n = len(part)
        if n < min_bytes:
            return
        summed = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:n], out=summed[1:])
        grams = (summed[gram:] - summed[:-gram]) * inverse[: n - gram + 1]
        grams = (grams ^ (grams >> np.uint64(32))) * SPREAD
        grams ^= grams >> np.uint64(29)
        # The smallest hash, the leftmost of equal ones: the place fills the low bits.
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        starts = np.arange(at, at + len(least))
        row = np.searchsorted(ends, starts, side="right")
        inside = np.flatnonzero(starts + min_bytes <= ends[row])
        if not len(inside):
            continue
        anchor = (least[inside] & low).astype(np.int64)
        new = np.ones(len(inside), bool)
        new[1:] = (np.diff(inside) != 1) | (np.diff(anchor) != 0)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(inside)))
        yield row[inside[first]], at + inside[first], count, grams[anchor[first]]


def anchored(docs: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """(gram, segment, doc_id, text_hash, start, starts) of all segments of all texts; ``segment``
    hashes the segment's bytes, ``starts`` counts the strings in it."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        data, offsets = utf8(batch.column(2))
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        for row, first, count, grams in segments(data, offsets, min_bytes, gram):
            ends = first + count + min_bytes - 1
            own = [digest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            take = pa.array(row)
            yield {
                "gram": grams.view(np.int64), "segment": np.array(own, np.uint64).view(np.int64),
                "doc_id": batch.column(0).take(take), "text_hash": batch.column(1).take(take),
                "start": (first - offsets[row]).astype(np.int32), "starts": count.astype(np.int16),
            }

    schema = "gram long, segment long, doc_id long, text_hash long, start int, starts short"
    return by_batch(docs, schema, run)


# ---- the corpus ------------------------------------------------------------------


def _same(a: str, b: str, *names: str) -> Column:
    found = F.lit(True)
    for n in names:
        one, other = F.col(f"{a}.{n}"), F.col(f"{b}.{n}")
        found &= one.eqNullSafe(other) if n == "doc_id" else one == other
    return found


def _repeated(docs: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """Segments whose gram occurs more than once. Counting takes the grams alone; the rows
    themselves then meet the repeated grams in a join, which splits hot ones."""
    grams = anchored(docs, min_bytes, gram).groupBy("gram").agg(F.count("*").alias("times"))
    often = stored(grams.filter("times > 1").select("gram"), "repeated-grams")
    release(docs.sparkSession)
    return stored(anchored(docs, min_bytes, gram).join(often, "gram"), "segments")


def _copies_and_firsts(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments that equal an earlier one, and the first of every segment whose gram has others."""
    place = F.struct(*POSITION)
    firsts = stored(
        found.groupBy("gram", "segment").agg(F.min(F.struct(*POSITION, "starts")).alias("f"), F.count("*").alias("times")),
        "first-segments",
    )
    # What is joined is stored first: adaptive execution splits hot keys only between plain shuffles.
    twice = firsts.filter("times > 1").select("gram", "segment", F.struct(*[F.col(f"f.{p}") for p in POSITION]).alias("first"))
    later = found.join(twice, ["gram", "segment"]).filter(place > F.col("first")).select(*POSITION, "starts")
    several = stored(firsts.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "rivalled-grams")
    rivals = firsts.join(several, "gram").select("gram", "kinds", "f.*")
    return stored(later, "copied-segments"), stored(rivals, "rival-segments")


def _with_bytes(rivals: DataFrame, docs: DataFrame, min_bytes: int) -> DataFrame:
    """(gram, kinds, doc_id, text_hash, start, starts, body): a document's rivals are bounded by its length."""
    lists = rivals.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("gram", "kinds", "start", "starts")).alias("at"))
    once = docs.alias("d").join(lists.alias("r"), _same("d", "r", "doc_id", "text_hash")).select(
        "d.doc_id", "d.text_hash", F.col("d.text").cast("binary").alias("text"), "r.at"
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = batch.column(3)
        at = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        gram, kinds, start, starts = (at.field(n) for n in range(4))
        begin = start.to_numpy()
        end = begin + starts.to_numpy() + min_bytes - 1
        texts, last, body = batch.column(2), -1, []
        for r, a, b in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
            if r != last:
                text, last = texts[r].as_py(), r
            body.append(text[a:b])
        take = pa.array(row)
        yield {
            "gram": gram, "kinds": kinds, "doc_id": batch.column(0).take(take), "text_hash": batch.column(1).take(take),
            "start": start, "starts": starts, "body": pa.array(body, pa.binary()),
        }

    schema = "gram long, kinds long, doc_id long, text_hash long, start int, starts short, body binary"
    return stored(by_batch(once, schema, run), "rival-bytes")


def later_strings(
    bodies: list[bytes], docs: np.ndarray, starts: np.ndarray, min_bytes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, from, to): runs of strings of ``bodies`` that occur earlier among them.

    ``docs`` ranks the segments' documents, ``starts`` places them there. Segments are set
    apart by 0xFF, which no UTF-8 text holds.
    """
    text = np.frombuffer(b"\xff".join([*bodies, b""]), np.uint8)
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begins = np.cumsum(lengths + 1) - lengths - 1
    own = np.repeat(np.arange(len(bodies)), lengths + 1)
    offset = np.arange(len(text)) - begins[own]
    order = suffix_order(text, min_bytes)
    order = order[offset[order] + min_bytes <= lengths[own[order]]]
    if not len(order):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    new = common_prefixes(text, order, min_bytes) < min_bytes
    new[0] = True
    place = (docs[own[order]] << 40) | (starts[own[order]] + offset[order])
    first = np.minimum.reduceat(place, np.flatnonzero(new))
    later = np.sort(order[place > first[np.cumsum(new) - 1]])
    if not len(later):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    cut = np.ones(len(later), bool)
    cut[1:] = np.diff(later) != 1
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(later)) - 1
    return own[later[head]], offset[later[head]], offset[later[tail]]


def _sorted_shards(rivals: DataFrame, min_bytes: int) -> DataFrame:
    """Spans in segments around grams with up to TOGETHER different ones, a block of grams at a time."""

    def settle(table: pa.Table) -> dict:
        ids, hashes = table["doc_id"], table["text_hash"].to_numpy()
        known = ids.is_valid().to_numpy()
        numbers = ids.fill_null(0).to_numpy()
        by = np.lexsort((hashes, numbers, known))
        step = np.zeros(len(by), np.int64)
        step[1:] = (np.diff(numbers[by]) != 0) | (np.diff(hashes[by]) != 0) | (known[by][1:] != known[by][:-1])
        ranks = np.empty(len(by), np.int64)
        ranks[by] = np.cumsum(step)
        begin = table["start"].to_numpy().astype(np.int64)
        # Positions of one block are ranked by document; 40 bits hold any start.
        own, first, last = later_strings(table["body"].to_pylist(), ranks, begin, min_bytes)
        take = pa.array(own)
        return {
            "doc_id": ids.take(take).combine_chunks(), "text_hash": table["text_hash"].take(take).combine_chunks(),
            "start": (begin[own] + first).astype(np.int32), "end": (begin[own] + last + min_bytes).astype(np.int32),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

        def out(table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in settle(table).items()}, schema)

        waiting: list[pa.Table] = []
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(waiting)
            grams = table["gram"].to_numpy()
            size = np.cumsum(pc.binary_length(table["body"]).to_numpy())
            heads = np.append(np.flatnonzero(np.append(True, np.diff(grams) != 0)), len(grams))
            done = 0
            for h in heads[1:-1].tolist():  # the last gram may go on in the next batch
                if size[h - 1] - (size[done - 1] if done else 0) >= BLOCK:
                    yield out(table.slice(done, h - done))
                    done = h
            waiting = [table.slice(done)]
        if waiting and waiting[0].num_rows:
            yield out(pa.concat_tables(waiting))

    some = rivals.filter(F.col("kinds") <= TOGETHER).select("gram", "doc_id", "text_hash", "start", "body")
    return some.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "doc_id long, text_hash long, start int, end int")


def _single_strings(rivals: DataFrame, min_bytes: int) -> DataFrame:
    """Spans around grams with more than TOGETHER different segments: every string by itself.

    The strings meet by 128 bits of hash, counted before they are shuffled; the first stays.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        digest = xxhash.xxh3_128_intdigest
        body, starts, begin = batch.column(4), batch.column(3).to_pylist(), batch.column(2).to_numpy()
        keys = [digest(view[n : n + min_bytes]) for b, k in zip(body, starts, strict=True) for view in [memoryview(b.as_py())] for n in range(k)]
        row = np.repeat(np.arange(batch.num_rows), starts)
        offset = np.concatenate([np.arange(k) for k in starts]) if starts else np.empty(0, np.int64)
        take, mask = pa.array(row), (1 << 64) - 1
        yield {
            "a": np.array([k & mask for k in keys], np.uint64).view(np.int64), "b": np.array([k >> 64 for k in keys], np.uint64).view(np.int64),
            "doc_id": batch.column(0).take(take), "text_hash": batch.column(1).take(take), "start": (begin[row] + offset).astype(np.int32),
        }

    many = rivals.filter(F.col("kinds") > TOGETHER).select("doc_id", "text_hash", "start", "starts", "body")
    strings = by_batch(many, "a long, b long, doc_id long, text_hash long, start int", run)
    place = F.struct(*POSITION)
    strings = stored(strings, "single-strings")
    firsts = strings.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("times")).filter("times > 1")
    firsts = stored(firsts, "first-strings")
    later = strings.join(firsts.select("a", "b", "first"), ["a", "b"]).filter(place > F.col("first"))
    return later.select("doc_id", "text_hash", "start", (F.col("start") + min_bytes).alias("end"))


def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, start, end) of byte spans, which may overlap, whose every string of
    ``min_bytes`` bytes also starts earlier: in a smaller doc_id or earlier in the document.

    ``docs`` has doc_id, text_hash and text. A null id counts as smaller than all; rows that
    share an id are ordered by the hash of their text, and equal rows are one document.
    Together they leave out no such string.
    """
    spark = docs.sparkSession
    found = _repeated(docs, min_bytes, gram)
    release(spark)
    later, rivals = _copies_and_firsts(found)
    release(spark)
    rivals = _with_bytes(rivals, docs, min_bytes)
    whole = later.select("doc_id", "text_hash", "start", (F.col("start") + F.col("starts") + (min_bytes - 1)).alias("end"))
    spans = stored(whole.union(_sorted_shards(rivals, min_bytes)).union(_single_strings(rivals, min_bytes)), "spans")
    release(spark)
    return spans


def remove_repeats(
    docs: DataFrame, *, min_bytes: int = MIN_BYTES, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row's doc_id, n_bytes, n_removed, n_spans (maximal removed runs), spans and kept.

    Each byte inside a string of ``min_bytes`` bytes that also starts earlier is removed; all
    strings are judged on the input. ``kept`` holds the other bytes in order (a cut may part a
    character, hence binary). Null and empty texts have no bytes, a text shorter than
    ``min_bytes`` keeps all. Extra columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spans = repeated_spans(rows, min_bytes, gram)
    lists = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.alias("d").join(lists.alias("s"), _same("d", "s", "doc_id", "text_hash"), "left").select("d.doc_id", F.col("d.text").cast("binary").alias("text"), "s.spans")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for n in range(0, batch.num_rows, 256):
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept")}
            part = batch.slice(n, 256)
            for i, text, found in zip(part.column(0).to_pylist(), part.column(1), part.column(2), strict=True):
                text, runs = text.as_py(), merged(found.values) if found.is_valid else []
                keep, at = [], 0
                for a, b in runs:
                    keep.append(text[at:a])
                    at = b
                keep.append(text[at:])
                removed = sum(b - a for a, b in runs)
                for k, v in zip(out, (i, len(text), removed, len(runs), [{"start": a, "end": b} for a, b in runs], b"".join(keep)), strict=True):
                    out[k].append(v)
            yield out

    return by_batch(joined, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: int, end: int>>, kept binary", run)


def merged(spans: pa.StructArray) -> list[tuple[int, int]]:
    """Disjoint runs that cover what ``spans`` cover; runs that touch are one."""
    start, end = spans.field(0).to_numpy(), spans.field(1).to_numpy()
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return list(zip(start[head].tolist(), reach[np.append(head[1:], len(start)) - 1].tolist(), strict=True))
