"""The rows of a partition sketch are made within a few copies of the hashes."""

import tracemalloc

import numpy as np

from quarterdeck.llm import sketch


def test_gaps_hold_few_copies_of_the_hashes():
    h = np.random.default_rng(1).integers(0, 1 << 63, 1 << 18).astype(np.uint64)
    for _ in sketch._gaps(h[:10], 24):  # what a first call loads does not count
        pass
    tracemalloc.start()
    for _ in sketch._gaps(h, 24):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * h.nbytes  # nine copies before


def test_gaps_name_every_counter():
    bits = 18
    h = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    wide, cells = sketch.block_bits(bits), []
    for batch in sketch._gaps(h, bits):
        for block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cells.append(sketch.decode_gaps(np.frombuffer(raw, np.uint8)) + (block << wide))
    want = np.concatenate([np.sort(sketch._cells(h, row, bits)) for row in range(sketch.ROWS)]).astype(np.int64)
    assert (np.concatenate(cells) == want).all()
