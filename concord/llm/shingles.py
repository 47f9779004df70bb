"""Word shingles of whole texts and their hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from concord.llm.common import chunks


def shingle_hashes(text: str | None, size: int, block: int = 1 << 16) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every shingle of ``size`` words, repeats included, in blocks of uint64.

    A-Z are lower-cased; words are runs without ASCII white space; a shingle's words are space-joined. A text with
    fewer words has its whole sequence as one shingle, a text without words has none.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        yield np.array([h(joined, 42)], dtype=np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    for a, b in chunks(len(starts), block):
        yield np.array([h(joined[s:e], 42) for s, e in zip(starts[a:b], ends[a:b])], dtype=np.uint64)
