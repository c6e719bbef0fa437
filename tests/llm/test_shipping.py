"""Workers need the installed libraries only, and long texts cost no more than their length."""

import os
import subprocess
import sys
import time

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from tallybridge.llm import pii, quality, secrets

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from tallybridge.session import build_session
from tallybridge.llm.queries import REGISTRY
spark = build_session("apart", "local[2]", spark__sql__shuffle__partitions="2")
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[1:]:
    print(name, REGISTRY[name](spark, "/root/testdata/sf0.001").count())
"""


def test_models_reach_workers_that_cannot_import_the_package(tmp_path):
    names = ["op1_mixing", "op4_language", "op5_quality", "op11_repair", "op12_ranked"]
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, *names], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names


@pytest.mark.parametrize("find, text", [
    (secrets.spans, "-----BEGIN RSA PRIVATE KEY-----\n" * 60_000),
    (pii.mentions, " ".join(f"u{n}@example{n % 7}.org" for n in range(90_000))),
])
def test_two_megabytes_of_markers_and_addresses(find, text):
    started = time.monotonic()
    found = find(text)
    assert time.monotonic() - started < 30
    assert len(found) == (0 if find is secrets.spans else 90_000)


def test_a_key_ends_with_the_first_end_of_its_label():
    text = "-----BEGIN A PRIVATE KEY-----a-----BEGIN PRIVATE KEY-----b-----END PRIVATE KEY-----c-----END PRIVATE KEY-----"
    assert [b for _, _, b in secrets.pem_blocks(text)] == ["b"]
    assert [b for _, _, b in secrets.pem_blocks(text.replace("c", "-----END A PRIVATE KEY-----"))][0].startswith("a-----BEGIN")


def test_different_words_count_once_in_a_text_of_many_pieces():
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = " ".join(a + b + c for a in letters for b in letters for c in letters)
    for times in (12, 40):
        (_, _, terms) = next(quality.term_rows(pa.array([f"{words} " * times])))
        assert np.flatnonzero(terms[0, -quality.REPEAT_BINS :]).tolist() == [0]
