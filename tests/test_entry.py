"""The driver's entry points, with and without the training-data operators."""

from __future__ import annotations

import subprocess
import sys

from conftest import ROOT

CODE = """
import sys, warnings
warnings.simplefilter("error" if {strict} else "always")
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
from listenlab.registry import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
"""


def run(name: str, strict: bool) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", CODE.format(name=name, strict=strict)], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_without_the_subpackage():
    done = run("listenlab.llm", strict=True)
    assert done.returncode == 0, done.stderr


def test_without_what_the_subpackage_needs():
    done = run("numpy", strict=False)
    assert done.returncode == 0, done.stderr
