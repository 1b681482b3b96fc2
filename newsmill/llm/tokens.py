"""Token ids of texts by a byte-level BPE vocabulary file."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Chunks whose ids a worker remembers (about 40 MB); further ones are encoded each time.
CACHE_ENTRIES = 150_000

# The pattern that byte-level vocabularies of this kind split texts by (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A stretch up to the next blank or line end after a word: no token reaches across its borders.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
# Characters on which two libraries could disagree about letters and white space.
_UNUSUAL = re.compile("[^\n\x20-\x7e\xa1-ɏ]").search


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one visible character: the printable ones of Latin-1 as
    themselves, the others in order from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids as little-endian 32-bit numbers, equal to those of ``tokenizers`` for the same file.

    ``tokenizers`` itself keeps offsets and the like for every token and encodes about 1 MB a second. So
    texts of usual characters are cut at blanks, the ids of a chunk are remembered, and the merges of an
    unknown chunk are made by ``tiktoken`` with the ranks of the same file. Texts with other characters
    go to ``tokenizers`` whole. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        special = {t["content"] for t in stored["added_tokens"]}
        byte = _byte_of_character()
        ranks = {bytes(byte[c] for c in t): n for t, n in stored["model"]["vocab"].items() if t not in special}
        self.part = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        ids = np.array(self.part.encode_ordinary(chunk), "<u4").tobytes()
        if len(self.known) < CACHE_ENTRIES:
            self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _UNUSUAL(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known, missing = self.known.get, self._chunk
        return b"".join([known(c) or missing(c) for c in _CHUNK(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
