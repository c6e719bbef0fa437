"""Secret spans against plain patterns, and structures that hold or do not."""

import base64
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybridge.llm import queries, secrets
from tallybridge.llm.features import utf8

KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"


def plain_base(text):
    found = [("assign", m) for m in re.finditer(rf"({KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return [(k, m.start(), m.end()) for k, m in sorted(found, key=lambda x: (x[1].start(), order.index(x[0])))]


def der(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else b"\x82" + n.to_bytes(2, "big")) + body


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, 129)) + b"\1") for _ in range(8)))
EC = der(0x30, der(2, b"\1") + der(4, bytes(range(32))) + der(0xA0, der(6, b"\x2a\x86\x48\xce\x3d\3\1\7")))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, bytes(32))))
SEALED = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d") + der(0x30, b"")) + der(4, bytes(64)))
PUBLIC = der(0x30, der(0x30, der(6, b"\x2b\x65\x70")) + der(3, b"\0" + bytes(32)))
field = lambda b: len(b).to_bytes(4, "big") + b
SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"public" * 5) + field(b"private" * 20)


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def kinds(text):
    return [(secrets.KINDS[k], a, b) for a, b, k in secrets.spans(text) if k >= secrets.BASE_KINDS]


@pytest.mark.parametrize("data", [RSA, EC, PKCS8, SEALED])
@pytest.mark.parametrize("before", ["", "key ", "«é🙂» key="])
def test_keys_in_any_coding(data, before):
    for coded in (b64(data), b64(data, True), data.hex(), data.hex().upper()):
        assert kinds(f"{before}{coded} after") == [("der", len(before), len(before) + len(coded))]


@pytest.mark.parametrize("data", [PUBLIC, RSA[:-1], RSA[:9] + b"\x7f" + RSA[10:], b"\x30\x82" + RSA[2:].replace(b"\x02\x81", b"\x02\x84"), bytes(200), SSH[:-1]])
def test_what_does_not_hold_together_is_no_key(data):
    assert kinds(f"key {b64(data)} after") == [] and kinds(f"key {data.hex()} after") == []


def test_ssh_and_pem():
    assert kinds(f"x {b64(SSH)}") == [("ssh", 2, 2 + len(b64(SSH)))]
    for label, data in (("RSA PRIVATE KEY", RSA), ("PRIVATE KEY", PKCS8), ("OPENSSH PRIVATE KEY", SSH)):
        lines = "\n".join(b64(data)[i : i + 64] for i in range(0, len(b64(data)), 64))
        block = f"-----BEGIN {label}-----\n{lines}\n-----END {label}-----"
        assert kinds(f"a\n{block}\nb") == [("pem", 2, 2 + len(block))]
        assert kinds(block.replace(lines[:40], "A" * 40)) == []


def test_signed_tokens():
    part = lambda x: b64(json.dumps(x).encode(), True)
    good = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.c2lnbmF0dXJl"
    assert kinds(f"token {good}, then") == [("jwt", 6, 6 + len(good))]
    for bad in (f"{part({'typ': 'JWT'})}.{part({})}.c2ln", f"{part({'alg': 'none'})}.bm90IGpzb24.c2ln", f"{part(['alg'])}.{part({})}.c2ln", "eyJ.eyJ.x"):
        assert kinds(bad) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "API_KEY", "ſecret", "toKen", '"', "'", " ", ":", "=", "AKIA", "ABCD1234EF", "0123456789abcdef", "abcdef" * 6, "é", "\t", "x"]), max_size=14).map("".join))
def test_base_spans_as_plain_patterns(text):
    found = [(secrets.KINDS[k], a, b) for a, b, k in secrets.spans(text) if k < secrets.BASE_KINDS]
    assert found == plain_base(text)
    assert not found or secrets.worth_reading(*utf8(pa.array(["", text, "y"])))[1]


def test_query_as_plain_patterns(spark, sf):
    found = {r.doc_id: r for r in queries.op3_secrets(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        base = plain_base(row.text or "")
        r = found[row.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert set(",".join(f"{k}:{a}:{b}" for k, a, b in base).split(",")) <= {*r.spans.split(","), ""}


def test_edge_rows(spark, edge, nothing):
    more = spark.createDataFrame([(20, "x " * 500_000 + "token: abcdefgh12")], "doc_id long, text string").join(edge.drop("doc_id", "text").limit(1))
    found = secrets.find_secrets(edge.unionByName(more)).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found if r.spans} == {20: [("assign", 1_000_000, 1_000_017, True)]}
    assert len(found) == edge.count() + 1 and all(r.spans == [] for r in found if r.doc_id != 20)
    assert secrets.find_secrets(nothing).count() == 0


def test_prefilter_reads_every_row_that_matters():
    texts = [None, "", "a" * 31 + " ", "0123456789abcdef" * 2, "x", b64(RSA), "", "my PASSWD='longenough'", "AKIA" + "A" * 12]
    assert secrets.worth_reading(*utf8(pa.array(texts))).tolist() == [False, False, False, True, False, True, False, True, True]
    assert not secrets.worth_reading(np.empty(0, np.uint8), np.zeros(1, np.int64)).any()


def test_tokens_before_a_full_stop():
    part = lambda x: b64(json.dumps(x).encode(), True)
    good = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.c2lnbmF0dXJl"
    sealed = f"{part({'alg': 'dir', 'enc': 'A128GCM'})}..aXY.dGV4dA.dGFn"
    for token in (good, sealed):
        for after in ("", ". Next", ".", "...", ".Next one", ".a.b.c"):
            assert kinds(f"token {token}{after}") == [("jwt", 6, 6 + len(token))]
    assert kinds(f"eyJ.{good}.{good}") == [("jwt", 4, 4 + len(good)), ("jwt", 5 + len(good), 5 + 2 * len(good))]


@pytest.mark.parametrize("end", ["\\n", "\\r\\n", "\\\\n", '\\n" +\n  "', "\\n'\n'"])
def test_pem_in_json_and_source_code(end):
    for label, data in (("RSA PRIVATE KEY", RSA), ("PRIVATE KEY", PKCS8), ("OPENSSH PRIVATE KEY", SSH)):
        lines = [b64(data)[i : i + 64] for i in range(0, len(b64(data)), 64)]
        block = end.join([f"-----BEGIN {label}-----", *lines, f"-----END {label}-----"])
        assert kinds(f'"private_key": "{block}{end}"') == [("pem", 16, 16 + len(block))]
        assert kinds(f'"private_key": "{block.replace("/", chr(92) + "/")}"')[0][0] == "pem"
        assert kinds(block.replace(lines[0][:40], "A" * 40)) == []
