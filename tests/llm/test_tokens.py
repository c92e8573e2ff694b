import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest

# In a process of its own, as a worker is: the MB that encoding a batch takes beside it, and that stay afterwards.
MEASURE = """
import resource, sys
import pyarrow as pa
from tableflow.llm.tokens import TokenEncoder

def resident():
    return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize() / 1e6

texts = [" ".join(f"word{7 * i + k} the river," for k in range(150)) for i in range(1000)]
texts = texts * (int(sys.argv[3]) * 1_000_000 // sum(map(len, texts)))
batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
del texts
encoder = TokenEncoder(sys.argv[1], sys.argv[2])
list(encoder.encode_batches([batch.slice(0, 1000)]))
before = resident()
for _ in encoder.encode_batches([batch]):
    pass
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024 / 1e6 - before, resident() - before)
"""


@pytest.mark.parametrize("name, split", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")])
def test_a_batch_takes_little_memory(name, split):
    """An executor's workers encode side by side, beside its heap; a batch of Spark's may be tens of MB."""
    root = str(Path(__file__).parents[2])
    args = [sys.executable, "-c", MEASURE, public_tokenizers.path(name), split, "40"]
    most, left = map(float, subprocess.run(args, cwd=root, capture_output=True, text=True, check=True).stdout.split())
    assert most < 150
    assert left < 60
