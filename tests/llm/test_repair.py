"""Conversation repair against exhaustive search on small conversations and plain tuples on whole tables."""

import hashlib
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybridge.llm import repair
from tallybridge.llm.queries import REGISTRY

BLANK = re.compile(r"[^\x20\x09-\x0D]")
WANTED = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def judged(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        shown = BLANK.findall(text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def exhaustive(rows):
    """The least (cost, audit, texts) over every sequence of edits that costs no more than deleting all."""
    best = [(3 * len(rows), "D" * len(rows), [])]

    def go(at, cost, audit, out):
        if cost > best[0][0]:
            return
        if at == len(rows) and WANTED.fullmatch("".join(o[:1] for o in out)):
            best[0] = min(best[0], (cost, audit, out))
        for role in ("user", "assistant"):
            go(at, cost + 2, audit + "I", [*out, f"{role}:"])
        if at < len(rows):
            role, text, fault = rows[at]
            go(at + 1, cost + 3, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                go(at + 1, more, audit + "K", [*out, f"{role}:{text}"])
                for to in ("user", "assistant"):
                    go(at + 1, more + 2, audit + "R", [*out, f"{to}:{text}"])

    go(0, 0, "", [])
    return best[0]


def by_tuples(rows):
    """The same by a table of the least (cost, audit, texts) for each text of initials so far, cut to what matters."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserted(table):
        for _ in range(4):
            for last, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in follow[last]:
                        new = (cost + 2, audit + "I", (*out, f"{role}:"))
                        table[role[0]] = min(table.get(role[0], new), new)
        return table

    for role, text, fault in rows:
        after = {}
        for last, (cost, audit, out) in inserted(best).items():
            choices = [(last, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                choices += [(role[:1], (more, audit + "K", (*out, f"{role}:{text}")))] if role[:1] and role[:1] in follow[last] else []
                choices += [(to[0], (more + 2, audit + "R", (*out, f"{to}:{text}"))) for to in ("user", "assistant") if to[0] in follow[last]]
            for state, new in choices:
                after[state] = min(after.get(state, new), new)
        best = after
    return min(value for last, value in inserted(best).items() if last in ("", "a"))


def expected(table):
    """The whole result from rows of (conv_id, turn, role, text)."""
    groups, kept = {}, {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, [])
        spoken = [" " if v is None else v for v in (role, text)]
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = "user" if code == 4 else spoken[0], "" if code == 1 else re.sub("[.!?]", "", spoken[1]) if code == 2 else spoken[1]
        for _ in range(0 if code == 0 else 2 if code == 3 else 1):
            kept.setdefault(conv, []).append((turn, role, text))
    out = []
    for conv in groups:
        rows = sorted(kept.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [t for t, _, _ in rows if t is not None]
        told = judged([r[1:] for r in rows])
        initials = [r[:1] for r, _, _ in told]
        cost, audit, texts = by_tuples(told)
        faults = [sum(f == name for _, _, f in told) for name in ("blank", "duplicate", "truncated")]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults,
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


SMALL = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["Yes.", "no", "", "Why?"])), max_size=4)


@settings(max_examples=150, deadline=None)
@given(SMALL)
def test_weights_find_what_every_sequence_of_edits_gives(rows):
    told = judged(rows)
    cost, audit, out = exhaustive(told)
    assert by_tuples(told) == (cost, audit, tuple(out))
    width = repair.SLOT_BITS * len(told)
    least = repair.weigh([(r, f) for r, _, f in told], repair.START)
    ends = [
        (w >> width) + more << width + 9 | (w & ((1 << width) - 1)) << 9 | repair.slot(letters)
        for state, w in least.items() for after, more, letters in repair.insertions(state) if after in repair.COMPLETE
    ]
    found = min(ends)
    assert (found >> width + 9, repair.letters_of(found & ((1 << width + 9) - 1), len(told) + 1)) == (cost, audit)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_against_plain_tuples(spark, sf):
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '/root/testdata/{sf}/conversations.parquet'").fetchall()
    assert got(REGISTRY["op11_repair"](spark, f"/root/testdata/{sf}")) == expected(table)


EDGE = [
    (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, None, "system", "Be kind."), (1, 1, None, "No role."), (1, 2, "assistant", None),
    (2, 0, "assistant", "Hm."), (2, 0, "assistant", "Aha."), (2, 0, "user", "Hm."), (None, 0, "user", "Nobody's."), (None, None, None, None),
    (3, 9_000_000_000, "user", "Far."), (3, -4, "assistant", "Near"), (4, 0, "user", "x" * 300_000 + "."), (5, 1, "umpire", "Out!"), (5, 2, "", "?"),
]


def test_nulls_ties_repeats_and_long_texts(spark):
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in EDGE], SCHEMA + ", fault int, `copies.x` double")
    assert got(repair.repair(frame)) == expected(EDGE)


def test_no_rows_after_damage_and_empty_tables(spark):
    dropped = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)
    assert got(repair.repair(frame)) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert got(repair.repair(frame.limit(0))) == []


def test_a_long_conversation_is_dealt_out_and_still_whole(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 7)
    roles = ["user", "assistant", "assistant", "system", "user", "tool"]
    table = [(1, n, roles[(n * n + n // 5) % 6], ["Fine.", f"Number {n}", f"Number {n}.", ""][(n * 7) % 4]) for n in range(600)]
    table += [(1, 1000, "user", "Again.")] * 90 + [(2, 0, "user", "Hi.")]
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert got(repair.repair(frame)) == expected(table)
    held = repair.blocks(repair.marked(repair.damaged(frame)))
    assert held.filter("conv_id = 1").count() > 80


def test_without_damage(spark):
    table = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes")]
    found = got(repair.repair(spark.createDataFrame(table, SCHEMA), damage=False))
    assert [f[5:8] for f in found] == [(1, 3, "DKK" if by_tuples(judged([r[2:] for r in table]))[1] == "DKK" else "KIKK")]
