"""Python workers need not find the package on their own path."""

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from lotguard.session import get_session
from lotguard.llm import chat_format, prefix_trie
from lotguard.llm.common import kept_in_worker
spark = get_session("local[2]", "elsewhere")
turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a")], "conv_id long, turn long, role string, text string")
print("DIGESTS", chat_format.read_back(chat_format.formatted(turns)).count())
print("NODES", prefix_trie.trie(prefix_trie.encoded(turns)).count())
"""


def test_session_started_elsewhere(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "DIGESTS 2" in out.stdout and "NODES 3" in out.stdout, out.stderr[-3000:]


def test_kept_in_worker():
    from lotguard.llm.common import kept_in_worker

    made = []
    make = lambda: made.append(1) or len(made)
    assert [kept_in_worker("test", v, make) for v in (1, 1, 2, 2, 1)] == [1, 1, 2, 2, 3]


def test_memory_is_given_back_behind_a_task():
    """What the encoder took goes back to the system when its batches end."""
    import numpy as np
    import psutil
    import pyarrow as pa

    from lotguard.llm import sentencepiece_lattice as S

    class Model:
        value = S.load_model()

    rng = np.random.default_rng(3)
    texts = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(10_000)) for _ in range(8)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts), pa.array(range(8))], names=["key", "text", "seed"])
    few = batch.slice(0, 1).set_column(1, "text", pa.array(["a few words"]))
    encoded = S._encoder(Model, 2)
    sizes = []
    for rows in (few, batch):
        for _ in encoded(iter([rows])):
            pass
        sizes.append(psutil.Process().memory_info().rss)
    assert sizes[1] - sizes[0] < 24 << 20
