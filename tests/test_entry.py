"""The entry points where a package or the text part is missing."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), sum(n.startswith("op") or n == "pipeline" for n in entry.queries()))
"""


def _left(*names):
    run = subprocess.run([sys.executable, "-c", BLOCKED.format(names=set(names))], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    return [int(x) for x in run.stdout.split()], run.stderr


def test_other_queries_stay_without_a_package_or_the_text_part():
    (queries, oracles, texts), said = _left("ahocorasick")
    assert queries >= 77 and oracles == queries and texts == 0 and "left out" in said
    (same, _, texts), said = _left("skylag.llm")
    assert same == queries and texts == 0 and "left out" not in said
