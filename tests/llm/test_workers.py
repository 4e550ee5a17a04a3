"""What tasks receive must load where this package is not installed."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from caselake.llm import chat, classifier, common, decontaminate, neardup, pieces, repair, search, suffixes

SENT = {
    "shingles": neardup._sketches, "estimates": neardup._estimated(80), "exact": neardup._exact(80),
    "index": search._indexed, "owner": search.owner_stage(0, 20, False), "runs": repair._runs, "joined": repair._joined,
    "counts": classifier._counts, "toxic": classifier._toxic_counts, "remove": suffixes._remove(True), "batches": chat._batches,
    "items": (decontaminate.search, decontaminate.Index), "pieces": (pieces.Encoder, pieces.Vocabulary, pieces.decode),
}


def loads_elsewhere(data: bytes, tmp_path) -> str:
    """Error text of loading ``data`` in a Python that cannot find this package."""
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import sys; from pyspark import cloudpickle; cloudpickle.loads(sys.stdin.buffer.read()); assert 'caselake' not in sys.modules"
    return subprocess.run([sys.executable, "-c", code], input=data, cwd=tmp_path, env=bare, capture_output=True).stderr.decode()


@pytest.mark.parametrize("name", sorted(SENT))
def test_task_functions_load_without_the_package(tmp_path, name):
    assert loads_elsewhere(cloudpickle.dumps(SENT[name]), tmp_path) == ""


def test_broadcast_values_are_plain(tmp_path):
    index = decontaminate.build_index([(1, "some item of the benchmark that is long enough to search")])
    assert loads_elsewhere(cloudpickle.dumps(common.plain(index)), tmp_path) == ""
    assert all(type(v).__module__ in ("builtins", "numpy") for v in common.plain(index))
