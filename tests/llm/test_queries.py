"""The registered queries against DuckDB where SQL can say them, and what holds for all."""

import subprocess
import sys

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from tallybridge.llm.queries import REGISTRY, SQL


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_duckdb(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    good, note, count = compare(spark, duck(sf_dir), sf_dir, REGISTRY[name], SQL[name])
    assert good and count, note


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) <= set(names) and "pipeline" in names


def test_nothing_else_imports_the_package():
    code = "import sys, pkgutil, importlib, tallybridge as t\nfor m in pkgutil.walk_packages(t.__path__, 't.'):\n    name = 'tallybridge' + m.name[1:]\n    if '.llm' not in name: importlib.import_module(name)\nassert not [m for m in sys.modules if m.startswith('tallybridge.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rpartition("/")[0])
