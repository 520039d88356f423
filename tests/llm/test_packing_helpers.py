import zlib

import numpy as np

from loomlink.llm import packing


def check(rows, ids, capacity):
    """Every piece of ids is there once, and sequences are gapless and within capacity."""
    by, seen = {}, {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for items in by.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
    assert set(seen) == set(ids)
    for k, own in ids.items():
        assert sorted(seen[k]) == [(p, s, m, zlib.crc32(np.array(own[s : s + m], "<u4").tobytes())) for p, (s, m) in enumerate(packing.cut(len(own), capacity))]
