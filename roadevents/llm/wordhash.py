"""Word sequences as 64-bit numbers, for operators that compare runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

from roadevents.llm.common import worker_cache

# Words whose numbers a worker keeps before it starts afresh.
KEPT_WORDS = 100_000


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def word_ids(texts: list[str | None]) -> list[np.ndarray]:
    """The words of each text, A-Z in lower case, cut at ASCII white space."""
    numbers = worker_cache("words", _Numbers)
    if len(numbers) > KEPT_WORDS:
        numbers.clear()
    of = numbers.__getitem__
    return [
        np.fromiter(map(of, (t or "").encode().lower().split()), np.uint64) for t in texts
    ]
