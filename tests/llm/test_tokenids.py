"""Token records: round trip, format, index, and the encoder against the library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybridge.llm import queries, tokenids
from tallybridge.session import fresh_dir

PATH = queries.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokenids.Encoder(PATH)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(text):
    return np.frombuffer(ENCODER.encode([text])[0], f"<u{ENCODER.width}").tolist()


@pytest.mark.parametrize(
    "text",
    ["", None, "It's <|endoftext|> done", "a,b..c , d. e", "don't  WE'RE\tx y", "ÀÉ×÷ß İı ſK", "é é.x", "x\x1cy\x1f z\x85q", "…»a,«", "99 bottles/\\</w>", "東京,tokyo.🙂"],
)
def test_encoder_agrees_with_the_library(text):
    assert encoded(text) == expected(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.characters(exclude_categories=["Cs"]), st.sampled_from(" ,.'\n<|>tsdmlrve")), max_size=60))
def test_encoder_agrees_on_any_text(text):
    assert encoded(text) == expected(text)


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokenids, "REMEMBERED", 3)
    small = tokenids.Encoder(PATH)
    texts = ["one two three four", "five one six", "Two, THREE."]
    assert [np.frombuffer(b, "<u2").tolist() for t in texts for b in small.encode([t])] == [expected(t) for t in texts]


def test_round_trip(spark, edge):
    folder = fresh_dir(spark, "test")
    tokenids.write_records(edge, f"{folder}/data", PATH, end_id=1)
    index = tokenids.write_index(spark, f"{folder}/data", f"{folder}/index")
    read = [(r.doc_id, r.ids) for r in tokenids.read_records(spark, f"{folder}/data").collect()]
    wanted = [(r.doc_id, [*expected(r.text), 1]) for r in edge.collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(read, key=key) == sorted(wanted, key=key)
    shuffled = [(r.doc_id, r.ids) for r in tokenids.read_shuffled(spark, f"{folder}/data", index, 3).collect()]
    assert sorted(shuffled, key=key) == sorted(wanted, key=key) and shuffled != sorted(wanted, key=key)
    rows = sorted(tokenids.positions(index).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in rows][:2] == [False, True]
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)
    before = 0
    for row in rows:
        assert row.start == before
        before += row.n_tokens


def test_digest_of_the_query(spark, sf):
    start, wanted = 0, {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*expected(row.text), 1]
        wanted[row.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r[1:]) for r in queries.op6_token_records(spark, sf).collect()} == wanted


def test_damage_is_noticed():
    data = tokenids.frame(tokenids.pack(5, b"\1\0\2\0", 2)) + tokenids.frame(tokenids.pack(None, b"", 2))
    assert [(at, tokenids.unpack(p)[0], tokenids.unpack(p)[1].tolist()) for at, p in tokenids.frames(data)] == [(0, 5, [1, 2]), (31, None, [])]
    for place in range(len(data)):
        broken = bytearray(data)
        broken[place] ^= 4
        with pytest.raises(ValueError):
            list(tokenids.frames(bytes(broken)))


def test_nothing(spark, nothing):
    folder = fresh_dir(spark, "test")
    tokenids.write_records(nothing, f"{folder}/data", PATH)
    assert tokenids.positions(tokenids.write_index(spark, f"{folder}/data", f"{folder}/index")).count() == 0
