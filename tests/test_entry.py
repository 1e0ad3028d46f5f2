"""The entry points, with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CORE = {name for name in entry.queries() if name != "pipeline" and not name.startswith("op")}


def names(folder, *block):
    blocked = "".join(f"sys.modules[{name!r}] = None; " for name in block)
    done = subprocess.run([sys.executable, "-c", f"import sys; {blocked}import __spark_entry__ as e; print(*e.queries())"], cwd=folder, capture_output=True, text=True, check=True)
    return set(done.stdout.split())


def copied(folder, *without):
    shutil.copytree(ROOT, folder, ignore=lambda path, found: [x for x in found if x in {".git", "__pycache__"} or os.path.relpath(os.path.join(path, x), ROOT) in without])
    return folder


def test_every_sql_text_has_its_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys() and CORE <= entry.oracle_sql().keys()


@pytest.mark.parametrize("without", [("plumbline/llm", "tests/llm"), ("plumbline/llm", "tests/llm", "corpus_pipeline.py")])
def test_without_the_operators(tmp_path, without):
    assert names(copied(tmp_path / "repo", *without)) == CORE


@pytest.mark.parametrize("module", ["xxhash", "tokenizers", "public_tokenizers"])
def test_without_their_libraries(module):
    assert CORE <= names(ROOT, module)
