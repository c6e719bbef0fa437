"""Sets of stream offsets as disjoint closed ranges per stream partition.

What RAW holds is kept as such ranges, so a landing learns from a few rows what is new, and
neither side's coordinates are shuffled for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..schemas import COORDINATES

PARTITION = COORDINATES[:2]
SPAN = [*PARTITION, "cell", "first", "last"]
#: Offsets of a cell, as many as one bitmap of Spark holds (4 KB).
CELL = 32_768
NEW, KNOWN, MIXED = "new", "known", "mixed"


#: Offsets of a block, as many as a number has bits, and the bits that a stretch of offsets leaves out.
BLOCK, STRETCH = 64, 20
#: Ranges that a row of their cell is compared with one by one, bytes that one takes, and bytes that are sent to every task.
FEW, RANGE_BYTES, SENT = 8, 100, 50_000_000


def block_of(offset: str):
    return F.expr(f"shiftright({offset}, 6)")


def cell_of(offset: str = "kafka_offset"):
    return F.expr(f"{offset} div {CELL}")


def cells(batch: DataFrame) -> DataFrame:
    """The batch by cells of CELL offsets, in one pass over the coordinates that combines in every task.

    ``offsets`` counts the different ones, exactly: each is a bit of the cell's bitmap. With the
    records ``received`` it tells copies, with ``first`` and ``last`` it tells holes. No message is read.
    """
    offset = F.col("kafka_offset")
    return batch.groupBy(*PARTITION, cell_of().alias("cell")).agg(
        F.count(F.lit(1)).alias("received"),
        F.min(offset).alias("first"),
        F.max(offset).alias("last"),
        F.bitmap_count(F.bitmap_construct_agg(F.pmod(offset, F.lit(CELL)))).alias("offsets"),
    )


def blocks(batch: DataFrame) -> DataFrame:
    """(topic, partition, block, received, first, last, mask): the batch by blocks of 64 offsets.

    The different offsets of a block are the bits of one number, so a group takes as little room where
    offsets lie far apart as where they lie close together.
    """
    offset, bit = F.col("kafka_offset"), F.expr(f"shiftleft(1L, CAST(pmod(kafka_offset, {BLOCK}) AS INT))")
    return batch.groupBy(*PARTITION, block_of("kafka_offset").alias("block")).agg(
        F.count(F.lit(1)).alias("received"), F.min(offset).alias("first"), F.max(offset).alias("last"), F.bit_or(bit).alias("mask")
    )


def cells_of(found: DataFrame) -> DataFrame:
    """The ``cells`` of the batch that the blocks ``found`` are of. A cell of far apart offsets holds no bitmap of 4 KB here."""
    return found.groupBy(*PARTITION, cell_of("first").alias("cell")).agg(
        F.sum("received").alias("received"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum(F.bit_count("mask")).alias("offsets"),
    )


def _merged(ranges: DataFrame, *by: str) -> DataFrame:
    """Ranges with those of one group that overlap or touch made one; a group is sorted by one task."""
    keys = [*PARTITION, *by]
    group = Window.partitionBy(*keys).orderBy("first", "last")
    before = F.max("last").over(group.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.select(*keys, "first", "last", F.coalesce(F.col("first") > before + 1, F.lit(True)).alias("opens"))
    numbered = opened.withColumn("island", F.sum(F.col("opens").cast("bigint")).over(group.rowsBetween(Window.unboundedPreceding, 0)))
    found = numbered.groupBy(*keys, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return found.drop("island")


def islands(ranges: DataFrame) -> DataFrame:
    """Ranges (topic, partition, first, last) with those that overlap or touch made one.

    A stretch of 2**STRETCH offsets is merged by itself, so a stream partition is as many groups. Then
    only what reaches the end of its stretch or is reached by an earlier one meets its like, at
    most two ranges a stretch.
    """
    local = _merged(ranges.withColumn("stretch", F.expr(f"shiftright(first, {STRETCH})")), "stretch")
    earlier = Window.partitionBy(*PARTITION).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    reached = local.groupBy(*PARTITION, "stretch").agg(F.max("last").alias("reach"))
    reached = reached.select(*PARTITION, "stretch", F.max("reach").over(earlier).alias("before"))
    past = lambda c: F.coalesce(c, F.lit(False))
    met = local.join(reached, [*PARTITION, "stretch"]).filter(~past(F.col("last") <= F.col("before")))
    ends = F.col("last") + 1 >= F.expr(f"shiftleft(stretch + 1, {STRETCH})")
    alone = F.when(~(ends | past(F.col("first") <= F.col("before") + 1)), F.col("stretch"))
    return _merged(met.withColumn("stretch", alone), "stretch").drop("stretch")


def in_cells(ranges: DataFrame) -> DataFrame:
    """(topic, partition, cell, first, last): ranges cut at the borders of cells, disjoint in each."""
    pieces = ranges.withColumn("stretch", F.explode(F.expr(f"sequence(shiftright(first, {STRETCH}), shiftright(last, {STRETCH}))")))
    start, end = F.expr(f"shiftleft(stretch, {STRETCH})"), F.expr(f"shiftleft(stretch + 1, {STRETCH}) - 1")
    pieces = pieces.select(*PARTITION, F.greatest("first", start).alias("a"), F.least("last", end).alias("b"))
    cut = pieces.withColumn("cell", F.explode(F.sequence(cell_of("a"), cell_of("b"))))
    # Division rounds to zero, so the cell 0 reaches to both sides of it.
    low = F.expr(f"cell * {CELL} - IF(cell > 0, 0, {CELL - 1})")
    high = F.expr(f"cell * {CELL} + IF(cell < 0, 0, {CELL - 1})")
    return _merged(cut.select(*PARTITION, "cell", F.greatest("a", low).alias("first"), F.least("b", high).alias("last")), "cell")


def masks(spans: DataFrame, *by: str) -> DataFrame:
    """(topic, partition, block, mask): the offsets of ``spans`` as blocks."""
    block = F.explode(F.sequence(block_of("first"), block_of("last")))
    cut = spans.select(*PARTITION, *by, "first", "last", block.alias("block"))
    low, high = F.expr(f"greatest(first - block * {BLOCK}, 0L)"), F.expr(f"least(last - block * {BLOCK}, {BLOCK - 1}L)")
    bits = cut.select(*PARTITION, *by, "block", low.cast("int").alias("low"), high.cast("int").alias("high"))
    mask = F.expr(f"shiftleft(shiftrightunsigned(-1L, {BLOCK - 1} - high + low), low)")
    return bits.groupBy(*PARTITION, *by, "block").agg(F.bit_or(mask).alias("mask"))


def without(found: DataFrame, held: DataFrame) -> DataFrame:
    """The blocks ``found`` (topic, partition, block, mask) less the offsets in the blocks ``held``."""
    known = held.groupBy(*PARTITION, "block").agg(F.bit_or("mask").alias("held"))
    left = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("held", F.lit(0).cast("bigint"))))
    return found.join(known, [*PARTITION, "block"], "left").select(*PARTITION, "block", left.alias("mask")).filter("mask <> 0")


def ranges_of(found: DataFrame) -> DataFrame:
    """(topic, partition, cell, first, last): the offsets of blocks as ranges, of which none leaves its cell."""
    places = lambda m: f"filter(sequence(0, {BLOCK - 1}), p -> getbit({m}, p) = 1)"
    opens, closes = "mask & ~shiftleft(mask, 1)", "mask & ~shiftrightunsigned(mask, 1)"
    marked = found.select(*PARTITION, (F.col("block") * BLOCK).alias("start"), F.expr(opens).alias("o"), F.expr(closes).alias("c"))
    placed = marked.select(*PARTITION, "start", F.expr(places("o")).alias("opens"), F.expr(places("c")).alias("closes"))
    runs_ = placed.select(*PARTITION, "start", F.explode(F.arrays_zip("opens", "closes")).alias("run"))
    told = runs_.select(*PARTITION, F.expr("start + run.opens").alias("first"), F.expr("start + run.closes").alias("last"))
    return _merged(told.withColumn("cell", cell_of("first")), "cell")


def size_of(wanted: DataFrame) -> Row:
    """Offsets, cells of more than FEW ranges, ranges of the other cells, and bounds of the disjoint ``wanted`` (topic, partition, cell, first, last)."""
    by_cell = wanted.groupBy(*PARTITION, "cell").agg(
        F.count(F.lit(1)).alias("ranges"), F.sum(F.expr("last - first + 1")).alias("offsets"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    dense = F.col("ranges") > FEW
    return by_cell.agg(
        F.coalesce(F.sum("offsets"), F.lit(0)).alias("offsets"), F.coalesce(F.sum(F.when(~dense, F.col("ranges"))), F.lit(0)).alias("ranges"),
        F.count_if(dense).alias("dense"), F.min("first").alias("first"), F.max("last").alias("last"),
    ).first()


def rows_in(df: DataFrame, wanted: DataFrame, size: Row) -> DataFrame:
    """Rows whose coordinates lie in ``wanted`` (topic, partition, cell, first, last), of which ``size`` is the size.

    A row meets the ranges of its cell. Where these are more than FEW, the cell is one row with a
    bit per offset instead, so no row is compared with many ranges. Up to SENT bytes of them are sent to every
    task; beyond that both sides are shuffled by cell.
    """
    if not size.offsets:
        return df.filter("false")
    keys = [*PARTITION, "cell"]
    side = wanted.select(*keys, "first", "last", F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("array<bigint>").alias("masks"))
    if size.dense:
        dense = wanted.groupBy(*keys).agg(F.count(F.lit(1)).alias("ranges")).filter(F.col("ranges") > FEW).select(*keys)
        side = side.join(dense, keys, "left_anti").unionByName(_by_bits(wanted.join(dense, keys, "left_semi")))
    side = side.toDF(*[f"r_{c}" for c in side.columns])
    offset = F.col("kafka_offset")
    inside = F.expr(f"getbit(get(r_masks, CAST(shiftright(kafka_offset, 6) - r_at AS INT)), CAST(pmod(kafka_offset, {BLOCK}) AS INT)) = 1")
    met = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"r_{c}") for c in PARTITION]) & (cell_of() == F.col("r_cell"))
    met = met & offset.between(F.col("r_first"), F.col("r_last")) & (F.col("r_masks").isNull() | inside)
    near = df.filter(offset.between(F.lit(size.first), F.lit(size.last)))
    sent = size.ranges * RANGE_BYTES + size.dense * CELL // 8
    return near.join(F.broadcast(side) if sent <= SENT else side, met, "left_semi")


def _by_bits(spans: DataFrame) -> DataFrame:
    """A row per cell: its bounds and, from its block ``at`` on, a mask per block."""
    keys = [*PARTITION, "cell"]
    found = masks(spans, "cell")
    empty = spans.groupBy(*keys).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    empty = empty.select(*keys, F.explode(F.sequence(block_of("first"), block_of("last"))).alias("block"), F.lit(0).cast("bigint").alias("mask"))
    filled = found.unionByName(empty).groupBy(*keys, "block").agg(F.bit_or("mask").alias("mask"))
    told = filled.groupBy(*keys).agg(F.min("block").alias("at"), F.max("block").alias("to"), F.sort_array(F.collect_list(F.struct("block", "mask"))).alias("of"))
    return told.select(*keys, F.expr(f"at * {BLOCK}").alias("first"), F.expr(f"to * {BLOCK} + {BLOCK - 1}").alias("last"), "at", F.col("of.mask").alias("masks"))


def is_torn():
    """Whether a cell has holes between its first and last offset."""
    return F.col("offsets") < F.col("last") - F.col("first") + 1


def spans(found: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """(topic, partition, cell, first, last, received): the offsets of the cells ``found`` as ranges without holes.

    A cell without holes is one by itself. Only the records of the others, for which ``batch`` is
    needed, are looked at one by one; there a group is a cell, so it has at most CELL offsets.
    """
    columns = [*PARTITION, "cell", "first", "last", "received"]
    whole = found.filter(~is_torn()).select(*columns)
    if batch is None:
        return whole
    torn = found.filter(is_torn()).select(*PARTITION, "cell", "first", "last")
    single = (
        batch.withColumn("cell", cell_of())
        .join(torn, [*PARTITION, "cell"]).filter(F.col("kafka_offset").between(F.col("first"), F.col("last")))
        .groupBy(*PARTITION, "cell", "kafka_offset").agg(F.count(F.lit(1)).alias("received"))
    )
    place = F.row_number().over(Window.partitionBy(*PARTITION, "cell").orderBy("kafka_offset"))
    exact = single.withColumn("run", F.col("kafka_offset") - place).groupBy(*PARTITION, "cell", "run").agg(
        F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"), F.sum("received").alias("received")
    )
    return whole.unionByName(exact.select(*columns))


def runs(found: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """The exact ranges of the offsets in the cells ``found``."""
    return islands(spans(found, batch))


def nearest(found: DataFrame, ranges: DataFrame, name: str) -> DataFrame:
    """``found`` (first, last) with the last of the disjoint ``ranges`` that begins by its end, as a struct ``name``.

    Ranges and rows lie in cells. If any range meets a row of ``found``, that one does. Both sides are sorted
    together per cell; nothing is compared pairwise.
    """
    columns = found.columns
    row = F.struct(*columns)
    kind = found.select(row.alias("row")).schema["row"].dataType
    left = found.select(*PARTITION, "cell", F.col("last").alias("at"), F.lit(1).alias("kind"), row.alias("row"))
    left = left.withColumn(name, F.lit(None).cast("struct<first:bigint,last:bigint>"))
    right = ranges.select(
        *PARTITION, "cell", F.col("first").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("row"),
        F.struct("first", "last").alias(name),
    )
    by = Window.partitionBy(*PARTITION, "cell").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right).withColumn(name, F.last(name, ignorenulls=True).over(by))
    return both.filter("kind = 1").select("row.*", name)


def judged(found: DataFrame, known: DataFrame, claimed: DataFrame) -> DataFrame:
    """Spans without holes and what is to be done about each.

    Neither ``known`` nor ``claimed`` need be disjoint. ``known``: one stored range covers it, all its records are stored. ``new``: no stored range and no
    claim of an unfinished landing meets it. ``mixed``: all others, whose offsets have to be looked up.
    """
    side = nearest(nearest(found, in_cells(known), "near"), in_cells(claimed), "claim")
    meets = lambda c: F.coalesce(F.col(f"{c}.last") >= F.col("first"), F.lit(False))
    inside = meets("near") & (F.col("near.first") <= F.col("first")) & (F.col("near.last") >= F.col("last"))
    status = F.when(inside, KNOWN).when(~meets("near") & ~meets("claim"), NEW).otherwise(MIXED)
    return side.withColumn("status", status).drop("near", "claim")


def offsets_within(found: DataFrame, ranges: DataFrame) -> DataFrame:
    """The coordinates of ``ranges`` that lie in the spans ``found``, of which none leaves its cell."""
    bounds = found.groupBy(*PARTITION).agg(F.min("first").alias("low"), F.max("last").alias("high"))
    near = ranges.join(bounds, PARTITION).filter("first <= high AND last >= low").select(
        *PARTITION, F.greatest("first", "low").alias("a"), F.least("last", "high").alias("b")
    )
    by_cell = near.withColumn("cell", F.explode(F.sequence(cell_of("a"), cell_of("b"))))
    # What the ranges hold of a cell's spans: at most CELL offsets.
    of_cell = found.groupBy(*PARTITION, "cell").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    met = by_cell.join(of_cell, [*PARTITION, "cell"])
    met = met.select(*PARTITION, F.greatest("a", "first").alias("a"), F.least("b", "last").alias("b")).filter("a <= b")
    return met.select(*PARTITION, F.explode(F.sequence("a", "b")).alias("kafka_offset"))


def holes(ranges: DataFrame) -> DataFrame:
    """(topic, partition, first, last, missing) between the disjoint ``ranges`` of each stream partition."""
    after = F.lead("first").over(Window.partitionBy(*PARTITION).orderBy("first"))
    found = ranges.withColumn("next", after).filter(F.col("next") > F.col("last") + 1)
    return found.select(
        *PARTITION, (F.col("last") + 1).alias("first"), (F.col("next") - 1).alias("last"), (F.col("next") - F.col("last") - 1).alias("missing")
    )
