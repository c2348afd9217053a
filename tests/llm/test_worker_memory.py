"""What a Python worker holds during and between tasks."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tests.llm.test_task_sizes import _Captured, _peak
from vittles.llm import pow2_packing, toxicity_nb


def test_a_worker_remembers_a_bounded_number_of_words():
    """Words are met once each but for a few: what is kept between texts stays small, and the frequent ones stay known."""
    own = pow2_packing.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = pow2_packing.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(30):
        texts = [" ".join(["the", "often, ", *(f"w{k}x{i}y{j}" for j in range(100))]) for i in range(100)]
        ids = own.encode(texts)
        assert len(own.known) < 250_000 and "often," in own.known
    assert ids == plain.encode(texts)


def test_toxicity_hashes_a_small_run_at_once():
    texts = [" ".join(f"w{(i * 7919 + j) % 5000}" for j in range(300)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    frame = _Captured()
    toxicity_nb.keep_clean(frame, toxicity_nb.Model(np.arange(4000), np.linspace(-1, 1, 4000), 0.1))
    assert _peak(lambda: list(frame.work(iter([batch])))) < 35


def test_a_plain_byte_level_file_leaves_nothing_behind():
    """Whole texts are encoded at once: no word is kept for texts to come."""
    encode = pow2_packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encode(["a first text"])
    tracemalloc.start()
    for k in range(20):
        encode([" ".join(f"w{k}x{i}y{j}" for j in range(100)) for i in range(20)])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 1_000_000
