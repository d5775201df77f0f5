import tracemalloc

import numpy as np

from spindrift.llm import induced, suffixdedup


def test_a_shard_sorts_in_bounded_memory(tmp_path):
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) + b" " for _ in range(3000)]
    text = b"".join(words[i] for i in rng.integers(0, 3000, suffixdedup.SHARD_BYTES // 6))
    parts = [text[i:i + 700] for i in range(0, suffixdedup.SHARD_BYTES, 700)]
    tracemalloc.start()
    found = induced.repeated(parts, 400, f"file://{tmp_path}")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(parts)
    # several tasks sort beside each other in an executor
    assert peak < 150 << 20
