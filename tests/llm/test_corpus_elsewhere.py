"""Executors that cannot import this library: the driver alone has it on its path, and works in another folder."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from feedloom.session import build_session
from feedloom.llm import packing, sentencepiece_codec, token_files
spark = build_session("local[2]", "elsewhere", spark__sql__shuffle__partitions="2")
docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "Größe und mehr")], "doc_id long, text string")
assert packing.pack_documents(docs).count() == 3
assert all(r.exact for r in sentencepiece_codec.round_trip(docs).collect())
assert [r.doc_id for r in token_files.round_trip(docs).orderBy("start").collect()] == [1, 2, 3]
print("all ran")
"""


def test_operators_run_where_the_library_is_not_installed(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=str(REPO))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]
