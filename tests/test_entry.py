"""The catalog with and without the training-data part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Hides modules as if their files were gone, then lists the catalog.
LISTING = """
import importlib.abc, sys
hidden = sys.argv[1:]

class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if any(name == h or name.startswith(h + ".") for h in hidden):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(" ".join(sorted(entry.queries())))
print(" ".join(sorted(entry.oracle_sql())))
"""


def _listed(*hidden):
    run = subprocess.run([sys.executable, "-c", LISTING, *hidden], cwd=ROOT, capture_output=True, text=True, check=False)
    assert run.returncode == 0, run.stderr
    queries, oracles = (set(line.split()) for line in run.stdout.splitlines())
    return queries, oracles


def _own():
    from costindex.plans.queries import registry
    return set(registry())


def test_catalog_without_the_training_data_part():
    # the folder alone gone (corpus_pipeline.py stays), or both
    for hidden in (["costindex.llm"], ["costindex.llm", "corpus_pipeline"]):
        queries, oracles = _listed(*hidden)
        assert queries == _own() and oracles == _own()


def test_an_error_inside_the_part_is_not_hidden():
    run = subprocess.run([sys.executable, "-c", LISTING, "numpy"], cwd=ROOT, capture_output=True, text=True, check=False)
    parts = subprocess.run([sys.executable, "-c", LISTING], cwd=ROOT, capture_output=True, text=True, check=False)
    if "op1_embedding_near_dedup" in parts.stdout:  # the part is installed and needs numpy
        assert run.returncode != 0 and "numpy" in run.stderr
