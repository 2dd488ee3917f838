"""The entry module with and without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = "import sys; sys.modules['tallyrill.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def test_entry_without_the_subpackage():
    said = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) >= 202 and said[1:] == ["0", "True"]


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "tallyrill")):
        for name in names:
            if name.endswith(".py") and os.sep + "llm" not in folder:
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    assert "tallyrill.llm" not in file.read(), name
