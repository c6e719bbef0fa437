"""Conversation structure repair by shortest paths with scalar big-integer weights.

A conversation is a DAG: a node is a row and a state of the wanted order of roles, an edge an edit. The weight of
an edge is one integer. Its high digits are the edit's cost. Below them every row has a slot of fixed width at its place,
which holds the letters of its edits from the left and zeros behind them. So the ordinary minimum
of sums finds the cheapest edits and, of equally cheap ones, those whose letters are ASCII-least.
No slot's letters begin another's, since each but the closing one ends with the row's own letter: the zeros never decide.

Rows are cut into blocks, and a block's weights are kept from every state to every state. Blocks are
weighed on their own, chained by their weights, and then written: a conversation of any length is
spread over tasks. Only its digest, which is defined over the whole, reads it in one pass, a block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, stored

# Initials of edits in ASCII order, their costs, and the signs that count as space.
DELETE, INSERT, KEEP, REROLE = "DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"

# What may follow, by the initial of a role: nothing yet, a system row, a user row, an assistant row.
START, SYSTEM, USER, REPLIED = range(4)
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": REPLIED}, REPLIED: {"u": USER}}
COMPLETE = (START, REPLIED)
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

#: A letter's digit, and the digits of a slot: a row's letter after at most two insertions. More never pay: a third would come back to a state.
DIGIT = {letter: n + 1 for n, letter in enumerate((DELETE, INSERT, KEEP, REROLE))}
DIGIT_BITS, SLOT_BITS = 3, 9
LETTER = {n: letter for letter, n in DIGIT.items()}
#: A block ends after so many rows or so many characters.
BLOCK_ROWS, BLOCK_CHARS = 512, 1 << 22

BLOCKS = (
    "conv_id {id}, part int, seq long, rows array<struct<role:string,text:string,fault:string>>, letters long, first string, last string, "
    "illegal long, blank long, duplicate long, truncated long, weights array<binary>"
)
CHAINED = "conv_id {id}, part int, seq long, entry int, audit string, cost long, illegal long"
REPAIRED = "conv_id {id}, cost long, illegal long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): ``rows`` damaged by crc32 of ``conv_id:turn``; a dropped one has 0 copies.

    Nulls read as one space, in the key as in role and text.
    """
    spoken = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn")).cast("binary")) % 20
    text = F.when(code == 1, F.lit("")).when(code == 2, F.translate(spoken("text"), ENDS, "")).otherwise(spoken("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(code == 4, F.lit("user")).otherwise(spoken("role")).alias("role"),
        text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` in their order with ``shape``, the fault their text has by itself, and with marks.

    Equal rows are combined before they are shuffled and unfolded again as copies. A mark (no
    ``shape``) stands before the first row of a conversation that has its role and text; any other
    row repeats one. A mark has the key of its row, so both are dealt to one task, and no group of equal
    texts is gathered anywhere.
    """
    keyed = rows.filter("copies > 0").withColumn("text_hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    single = keyed.groupBy("conv_id", "turn", "role", "text_hash", "text").agg(F.sum("copies").alias("copies"))
    first = keyed.groupBy("conv_id", "role", "text_hash").agg(F.min(F.struct("turn")).alias("first"))
    shown = F.expr(f"trim(BOTH '{_sql(SPACE)}' FROM text)")
    shape = F.when(shown == "", "blank").when(~F.right(shown, F.lit(1)).isin(*ENDS), "truncated").otherwise("")
    copies = single.select("conv_id", "turn", "role", "text_hash", "text", shape.alias("shape"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    # A copy is never written again, nor is a blank row, so their texts are left behind.
    copies = copies.withColumn("text", F.when((F.col("copy") == 1) & (F.col("shape") != "blank"), F.col("text")).otherwise(F.lit("")))
    marks = first.select(
        "conv_id", F.col("first.turn").alias("turn"), "role", "text_hash", F.lit("").alias("text"), F.lit(None).cast("string").alias("shape"), F.lit(1).alias("copy")
    )
    return copies.unionByName(marks)


def _sql(text: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in text)


def steps(state: int, initial: str, fault: str) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, letters) of every way to deal with a row, insertions before it included."""
    for before, cost, letters in insertions(state):
        yield before, cost + COSTS[DELETE], letters + DELETE
        if fault in ("blank", "duplicate"):
            continue
        left = cost + (TRUNCATED_COST if fault == "truncated" else 0)
        follow = STEPS[before]
        if initial in follow:
            yield follow[initial], left + COSTS[KEEP], letters + KEEP
        for to in NAMES:
            if to in follow:
                yield follow[to], left + COSTS[REROLE], letters + REROLE


def insertions(state: int) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, letters) of up to two insertions."""
    for n in range(3):
        yield state, n * COSTS[INSERT], INSERT * n
        state = next(after for initial, after in STEPS[state].items() if initial in NAMES)


def slot(letters: str) -> int:
    """Letters as digits from the left of a slot, with zeros behind them."""
    digits = 0
    for n, letter in enumerate(letters):
        digits |= DIGIT[letter] << (SLOT_BITS - DIGIT_BITS * (n + 1))
    return digits


def edges(initial: str, fault: str) -> list[tuple[int, int, int, int]]:
    """(state, state after, cost, slot) of every way to deal with a row of that kind, remembered by each worker."""
    known = kept("repair-edges", dict)
    if (initial, fault) not in known:
        known[initial, fault] = [
            (state, to, cost, slot(letters)) for state in STEPS for to, cost, letters in steps(state, initial, fault)
        ]
    return known[initial, fault]


def weigh(rows: list[tuple[str, str]], entry: int) -> dict[int, int]:
    """The least weight from ``entry`` to every state over rows of (role, fault).

    A weight is a cost shifted by the width of all slots, and the slots. The minimum of these sums decides alone.
    """
    width = SLOT_BITS * len(rows)
    best, shift = {entry: 0}, width
    for role, fault in rows:
        shift -= SLOT_BITS
        after: dict[int, int] = {}
        for state, to, cost, letters in edges(role[:1] if role[:1] in "sua" else "", fault):
            if state in best:
                total = best[state] + (cost << width) + (letters << shift)
                if to not in after or total < after[to]:
                    after[to] = total
        best = after
    return best


def letters_of(weight: int, rows: int) -> str:
    """The letters in the slots of a weight."""
    digits = weight & ((1 << (SLOT_BITS * rows)) - 1)
    found = []
    for n in range(SLOT_BITS * rows // DIGIT_BITS - 1, -1, -1):
        digit = (digits >> (DIGIT_BITS * n)) & 7
        if digit:
            found.append(LETTER[digit])
    return "".join(found)


def write(rows: list[tuple[str, str, str]], audit: str, state: int) -> tuple[list[str], int]:
    """What the edits of ``audit`` make of rows of (role, text, fault): ``role:text`` of each, and the state after."""
    out, at = [], 0
    for letter in audit:
        role, text, _ = ("", "", "") if letter == INSERT else rows[at]
        at += letter != INSERT
        if letter == DELETE:
            continue
        if letter != KEEP:
            initial = next(i for i in STEPS[state] if i in NAMES)
            role = NAMES[initial]
        state = STEPS[state][role[:1]]
        out.append(f"{role}:{text}")
    return out, state


def _block(conv, part: int, seq: int, rows: list[tuple[str, str, str]]) -> tuple:
    plain = [(role, fault) for role, _, fault in rows]
    initials = [role[:1] for role, _ in plain]
    count = lambda fault: sum(f == fault for _, f in plain)
    weights = []
    for entry in range(len(STEPS)):
        least = weigh(plain, entry)
        for to in range(len(STEPS)):
            weight = least.get(to)
            weights.append(None if weight is None else weight.to_bytes((weight.bit_length() + 7) // 8 or 1, "big"))
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    named = [{"role": r, "text": t, "fault": f} for r, t, f in rows]
    return (conv, part, seq, named, len(rows), initials[0], initials[-1], illegal, count("blank"), count("duplicate"), count("truncated"), weights)


def blocks(rows: DataFrame) -> DataFrame:
    """Rows in order, cut into blocks of one conversation each, with what a block costs from state to state.

    Range partitions follow the order of rows, down to the copies of one, so a conversation of any
    size is dealt out over tasks; (part, seq) orders the blocks of a conversation and names each.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text_hash", "copy"]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order, "shape").select("conv_id", "role", "text", "shape")
    schema = rows.sparkSession.createDataFrame([], BLOCKS.format(id=kind)).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, seq, current, held, chars, mark = TaskContext.get().partitionId(), 0, None, [], 0, False
        for batch in batches:
            for conv, role, text, shape in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shape is None:  # sorts before its row
                    mark = True
                    continue
                fault = shape if mark or shape == "blank" else "duplicate"
                mark = False
                if held and (conv != current or len(held) >= BLOCK_ROWS or chars >= BLOCK_CHARS):
                    yield _block(current, part, seq, held)
                    seq, held, chars = seq + 1, [], 0
                current = conv
                held.append((role, text, fault))
                chars += len(text)
        if held:
            yield _block(current, part, seq, held)

    return _streamed(laid, schema, cut)


def _streamed(df: DataFrame, schema, function) -> DataFrame:
    """``function`` turns a task's Arrow batches into tuples, which leave a few at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        gathered, weight = [], 0
        for row, size in _sized(function(batches)):
            gathered.append(row)
            weight += size
            if len(gathered) >= 1000 or weight >= BLOCK_CHARS:
                yield packed(gathered)
                gathered, weight = [], 0
        if gathered:
            yield packed(gathered)

    return df.mapInArrow(run, schema)


def _sized(rows: Iterable[tuple]) -> Iterator[tuple[tuple, int]]:
    for row in rows:
        yield row, sum(len(v) if isinstance(v, str) else sum(len(r["text"]) for r in v) if isinstance(v, list) and v and isinstance(v[0], dict) else 8 for v in row)


def chain(built: DataFrame) -> DataFrame:
    """The letters of the cheapest edits of a conversation in each of its blocks, and the state it is entered in.

    Only the weights travel. Costs of blocks add up; of what was written before, only the order of the
    four states' letters matters, so their rank stands for it below the cost. The last block of a conversation carries
    its cost and illegal pairs.
    """
    rows = built.select("conv_id", "part", "seq", "letters", "first", "last", "illegal", "weights")
    laid = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    schema = built.sparkSession.createDataFrame([], CHAINED.format(id=built.schema["conv_id"].dataType.simpleString())).schema

    def settle(conv, path: list, best: dict, illegal: int) -> Iterator[tuple]:
        ends = []
        for state, (cost, rank) in best.items():
            for after, more, letters in insertions(state):
                if after in COMPLETE:
                    ends.append((((cost + more) << (2 + SLOT_BITS)) + (rank << SLOT_BITS) + slot(letters), state, letters))
        weight, state, closing = min(ends)
        end = (weight >> (2 + SLOT_BITS), illegal)
        for part, seq, rows, came in reversed(path):
            entry, raw = came[state]
            yield conv, part, seq, entry, letters_of(int.from_bytes(raw, "big"), rows) + closing, *end
            state, closing, end = entry, "", (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, path, best, illegal, before = None, [], {START: (0, 0)}, 0, None
        for batch in batches:
            for conv, part, seq, letters, first, last, own, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path and conv != current:
                    yield from settle(current, path, best, illegal)
                    path, best, illegal, before = [], {START: (0, 0)}, 0, None
                current = conv
                illegal += own + (before is not None and before + first not in LEGAL)
                before = last
                width, reached = SLOT_BITS * letters, {}
                for entry, (cost, rank) in best.items():
                    for to in range(len(STEPS)):
                        if (raw := weights[entry * len(STEPS) + to]) is None:
                            continue
                        weight = int.from_bytes(raw, "big")
                        slots = weight & ((1 << width) - 1)
                        total = ((cost + (weight >> width)) << (width + 2)) + (rank << width) + slots
                        if to not in reached or total < reached[to][0]:
                            reached[to] = (total, entry, raw)
                path.append((part, seq, letters, {to: (entry, raw) for to, (_, entry, raw) in reached.items()}))
                told = {to: total & ((1 << (width + 2)) - 1) for to, (total, _, _) in reached.items()}
                order = sorted(set(told.values()))
                best = {to: (total >> (width + 2), order.index(told[to])) for to, (total, _, _) in reached.items()}
        if path:
            yield from settle(current, path, best, illegal)

    return _streamed(laid, schema, run)


def joined(built: DataFrame, chained: DataFrame) -> DataFrame:
    """The letters of a conversation and the digest of its rewritten rows, a block at a time.

    The blocks of a conversation follow one another, each behind its letters. The digest is defined over
    the whole conversation, so one task reads it; it holds a block of it and the letters.
    """
    kind = built.schema["conv_id"].dataType.simpleString()
    nothing = lambda df, name: F.lit(None).cast(df.schema[name].dataType).alias(name)
    names = ["entry", "audit", "cost", "illegal"]
    texts = built.select("conv_id", "part", "seq", F.lit(1).alias("kind"), "rows", *[nothing(chained, n) for n in names])
    letters = chained.select("conv_id", "part", "seq", F.lit(0).alias("kind"), nothing(built, "rows"), *names)
    laid = texts.unionByName(letters).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "kind")
    schema = built.sparkSession.createDataFrame([], REPAIRED.format(id=kind)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        digest, audit, some, told = hashlib.sha256(), [], False, ()
        for batch in batches:
            for conv, held, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None:
                    told = own
                    continue
                entry, letters, cost, illegal = told
                out, _ = write([(r["role"], r["text"], r["fault"]) for r in held], letters, entry)
                audit.append(letters)
                for line in out:
                    digest.update((("\n" if some else "") + line).encode("utf-8", "surrogatepass"))
                    some = True
                if cost is not None:
                    yield conv, cost, illegal, "".join(audit), digest.hexdigest()
                    digest, audit, some = hashlib.sha256(), [], False

    return _streamed(laid.select("conv_id", "rows", *names), schema, run)


def repair(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """A row per conversation: its faults, the cheapest edits that mend it, and a digest of what they give.

    ``conversations`` has conv_id, turn, role and text; extra columns are not read. Rows follow ``turn``, nulls
    first; those of equal ``turn`` follow role and a hash of the text, which also puts copies side by side. Null roles and texts read as one
    space, so such a text is blank; rows without a ``conv_id`` are one conversation. With ``damage`` rows are first damaged as
    ``damaged`` says. A conversation of which no row is left has zeros, an empty audit and the hash of
    nothing. An empty table gives no rows.
    """
    if damage:
        told = damaged(conversations)
    else:
        spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
        told = conversations.select("conv_id", "turn", *spoken, F.lit(1).alias("copies"))
    built = stored(blocks(marked(told)), "blocks")
    chained = stored(chain(built), "chained")
    ends = joined(built, chained)
    left = F.when(F.col("copies") > 0, F.col("turn"))
    every = told.groupBy("conv_id").agg(
        F.coalesce(F.max(left) - F.min(left) + 1 - F.count_distinct(left), F.lit(0)).cast("long").alias("gaps")
    )
    named = built.groupBy(F.col("conv_id").alias("c")).agg(*[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")])
    found = every.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    found = found.join(ends.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counted: list[Column] = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select("conv_id", *counted, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
