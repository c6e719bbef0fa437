"""Chat examples: exact round trip, masks, and the edge cases."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybridge.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
SIGNS = st.lists(st.sampled_from([*"\\<>/turn lsg\n", "é", "🙂", "</turn>\n", "<turn assistant>\n"]), max_size=12).map("".join)


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "system", "a>b\\"]), SIGNS), min_size=1, max_size=30))
def test_everything_is_read_back(spark, rows):
    table = [(conv, n, role, text) for n, (conv, role, text) in enumerate(rows)]
    found = chat.examples(spark.createDataFrame(table, SCHEMA))
    last = found.filter("is_last").select("conv_id", chat.turns_of(F.col("text")).alias("turns")).collect()
    trained = found.select("conv_id", "example", chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))).collect()
    for conv in {r[0] for r in table}:
        own = [(r[2], r[3]) for r in table if r[0] == conv]
        assert [tuple(t) for r in last if r.conv_id == conv for t in r.turns] == own
        replies = [text for role, text in own if role == "assistant"]
        assert [r[2] for r in sorted(trained) if r[0] == conv] == replies + ([] if own[-1][0] == "assistant" else [""])


def test_an_example_per_reply_with_what_came_before(spark):
    table = [(1, 0, "system", "Be <brief>."), (1, 1, "user", "a"), (1, 2, "assistant", "b\\"), (1, 3, "user", "c"), (1, 4, "assistant", "d")]
    found = sorted(tuple(r) for r in chat.examples(spark.createDataFrame(table, SCHEMA)).collect())
    first = "<turn system>\nBe \\lbrief\\g.</turn>\n<turn user>\na</turn>\n<turn assistant>\nb\\s</turn>\n"
    second = first + "<turn user>\nc</turn>\n<turn assistant>\nd</turn>\n"
    assert [(r[1], r[2], r[3]) for r in found] == [(1, False, first), (2, True, second)]
    assert [r[3][r[4] : r[5]] for r in found] == ["b\\s", "d"]


def test_nulls_ties_repeats_long_texts_and_other_columns(spark):
    table = [
        (1, 0, None, None), (1, 0, "assistant", "same"), (1, 0, "assistant", "same"), (1, None, "user", ""),
        (None, 5, "assistant", "nobody's"), (2, 1, "user", "x<" * 400_000), (3, 0, "assistant", ""),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA + ", example string, `text.b` int")
    found = {r.conv_id: r for r in chat.read_back(chat.examples(frame)).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in found.items()} == {1: (4, 8), None: (1, 8), 2: (1, 0), 3: (1, 0)}
    assert found[2].formatted_chars == 1_200_000 + len("<turn user>\n</turn>\n")
    assert chat.read_back(chat.examples(frame.limit(0))).count() == 0


def test_no_python_worker_is_in_the_plan(spark):
    plan = chat.read_back(chat.examples(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
