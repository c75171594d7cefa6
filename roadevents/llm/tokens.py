"""Token ids of whole texts with a public tokenizer, one cached word at a time."""

from __future__ import annotations

import re
import struct

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from roadevents.llm.common import worker_cache

WORD_BPE = "word_bpe_49k.json"
# Words after which a worker's cache is renewed; the one before is kept beside it.
KEPT_WORDS = 400_000


# Letters of ASCII and Latin-1, perhaps with ASCII marks other than an apostrophe after
# them: such a word is one pre-token, or two, and normalising only lower-cases it.
_PLAIN = re.compile(r"([a-zÀ-ÖØ-Þß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The visible character that byte-level models use for each byte above ASCII.

    Bytes that are no visible Latin-1 characters take the code points from 256 on, after
    the 33 control characters and the space and DEL among ASCII bytes.
    """
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}


class Encoder:
    """Ids of a word-wise tokenizer, which never joins characters across white space.

    So the ids of a text are those of its parts between spaces and line ends, and each
    part is encoded once while it stays in the cache. The tokenizer lower-cases; doing so
    for A-Z beforehand makes for fewer parts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.marks = {"": b""}
        # By the words' UTF-8 bytes, which are cut without being decoded again.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(own.ids, "<u4").tobytes() for own in found]

    def _spelled(self, letters: str) -> bytes:
        # ASCII letters of plain words are small ones already.
        if not letters.isascii():
            letters = letters.lower().encode().decode("latin-1").translate(self.letters)
        ids = [piece.id for piece in self.tokenizer.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[bytes]) -> None:
        odd = []
        for word in new:
            plain = _PLAIN.fullmatch(word.decode())
            if not plain:
                odd.append(word)
                continue
            letters, marks = plain.groups()
            if marks not in self.marks:
                self.marks[marks] = self._whole([marks])[0]
            key = letters.encode()
            own = self.known.get(key) or self.older.get(key)
            self.known[word] = (own or self._spelled(letters)) + self.marks[marks]
        for at in range(0, len(odd), 10_000):
            part = odd[at : at + 10_000]
            whole = self._whole([word.decode() for word in part])
            self.known.update(zip(part, whole, strict=True))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = []
        for text in texts:
            data = text.encode()
            # Where a special token's spelling may stand, case matters.
            if b"<|" not in data:
                data = data.lower()
            split.append(data.replace(b"\n", b" ").split(b" "))
        if len(self.known) > KEPT_WORDS:
            # What is met again comes back from here; the rest goes with the next turn.
            self.known, self.older = {}, self.known
            self.marks = {"": b""}
        new = set().union(*split).difference(self.known) if split else set()
        back = self.older.keys() & new
        self.known.update(zip(back, map(self.older.__getitem__, back), strict=True))
        self._learn(list(new - back))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, own)), "<u4") for own in split]


def encoder(tokenizer: str | None = None) -> Encoder:
    """This process's encoder; ``tokenizer`` is a file, by default the word-wise BPE."""
    found = f"tokens {tokenizer or WORD_BPE}"
    return worker_cache(found, lambda: Encoder(tokenizer or public_tokenizers.path(WORD_BPE)))
