from __future__ import annotations

import subprocess
import sys

import pytest

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(q.startswith("op") and q[2].isdigit() or q == "pipeline" for q in e.queries()))
"""


@pytest.mark.parametrize("name", ["crewspark.llm", "xxhash"])
def test_entry_without_the_optional_part(name):
    out = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, oracles, optional = out.stdout.split()
    assert int(queries) > 85 and int(oracles) > 75 and optional == "False"


def test_a_broken_library_is_not_hidden():
    out = subprocess.run([sys.executable, "-c", HIDE.format(name="crewspark.plans")], capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "crewspark.plans" in out.stderr
