"""Repeated byte strings: suffix arrays, and removal against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybridge.llm import suffix


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.binary(max_size=120), st.text("ab", max_size=120).map(str.encode)))
def test_suffix_order_and_prefixes(data):
    text = np.frombuffer(data, np.uint8)
    order = suffix.suffix_order(text, len(data) + 8)
    wanted = sorted(range(len(data)), key=lambda i: data[i:])
    assert order.tolist() == wanted

    def shared(a, b):
        n = 0
        while n < 20 and a + n < len(data) and b + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        return n

    if len(data):
        found = suffix.common_prefixes(text, order, 20).tolist()
        assert found == [0] + [shared(a, b) for a, b in zip(wanted, wanted[1:], strict=False)]


def test_only_the_smaller_suffixes_are_sorted_directly():
    data = b"mississippi"
    wanted = [data[i:] < data[i + 1 :] for i in range(len(data) - 1)] + [False]
    assert suffix.smaller_than_next(np.frombuffer(data, np.uint8)).tolist() == wanted


def brute(docs, size):
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - size + 1):
            part = data[i : i + size]
            if part in seen:
                gone[i : i + size] = True
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, len(data), int(gone.sum()), runs, kept))
    return sorted(out, key=str)


def passages(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, line, docs = [text(30) for _ in range(6)], "the same line in many texts ", []
    for n in range(60):
        kind = n % 6
        body = text(draw.randint(0, 60))
        if kind == 1:
            body += draw.choice(shared) + text(5)
        elif kind == 2:
            body = line + body
        elif kind == 3:
            body = draw.choice(shared)[: draw.randint(1, 200)] + line + draw.choice(shared)
        elif kind == 4 and docs:
            body = draw.choice(docs)[1] or ""
            at = draw.randint(0, len(body))
            body = body[:at] + draw.choice(["", "x"]) + body[at:]
        elif kind == 5:
            body = draw.choice(["ab" * 90, "a" * 150, (line + "z") * 4])
        docs.append((n, body))
    return docs


@pytest.mark.parametrize(("size", "gram", "together", "block"), [(100, 24, 4096, 1 << 20), (40, 8, 4096, 700), (30, 8, 2, 1 << 20), (12, 4, 3, 90)])
def test_as_brute_force(spark, monkeypatch, size, gram, together, block):
    """Also with texts cut into small blocks, and with nearly all grams taken for hot ones."""
    monkeypatch.setattr(suffix, "TOGETHER", together)
    monkeypatch.setattr(suffix, "BLOCK", block)
    docs = [*passages(size), (100, None), (101, ""), (102, "short")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = suffix.remove_repeats(frame, min_bytes=size, gram=gram).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=str) == brute(docs, size)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_edge_rows(edge, nothing):
    found = suffix.remove_repeats(edge).collect()
    assert len(found) == edge.count()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].n_bytes == 0 and by_id[i].kept == b"" for i in (3, 4))
    assert [r.n_removed for r in found if r.doc_id == 7] == [0, 0]  # equal rows are one document
    assert by_id[None].n_removed == 0
    assert suffix.remove_repeats(nothing).count() == 0


def test_one_id_with_two_texts(spark):
    body = "0123456789" * 3 + "abcdefghij" * 10
    docs = spark.createDataFrame([(1, body), (1, "x" + body)], "doc_id long, text string")
    found = suffix.remove_repeats(docs).collect()
    assert sorted(r.n_removed > 100 for r in found) == [False, True] or all(r.n_removed for r in found)
