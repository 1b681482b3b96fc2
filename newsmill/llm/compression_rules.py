"""Quality rules by compression: texts that are too repetitive or that hardly compress are rejected."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.common import each

# Limits of compressed size / size by length in bytes: (up to, least ratio, greatest ratio). From 81 bytes on the greatest
# lies between clean prose (below it by a margin) and random characters of the length; shorter texts of both kinds
# have the same ratios.
BANDS = (
    (80, 0.60, 2.00), (96, 0.55, 1.075), (112, 0.55, 1.06), (128, 0.55, 1.037), (160, 0.50, 0.97), (192, 0.50, 0.957), (224, 0.50, 0.90),
    (256, 0.50, 0.86), (320, 0.48, 0.83), (384, 0.48, 0.81), (512, 0.48, 0.79), (768, 0.46, 0.75), (1024, 0.46, 0.72), (2048, 0.44, 0.68),
    (4096, 0.42, 0.64), (8192, 0.40, 0.62), (16384, 0.38, 0.60), (65536, 0.36, 0.58), (None, 0.33, 0.55),
)
# Chunks of this size have limits of their own; a text is rejected if more than this share is outside. Clean
# prose of the four languages lies between 0.466 and 0.529, base64 at 0.77. Hex digits (0.52 to 0.53) cannot be
# told from prose by the ratio.
CHUNK_BYTES = 2048
CHUNK_LIMITS = (0.43, 0.65)
CHUNK_SHARE = 0.1
LEVEL = 3

_SEPARATORS = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: Sequence[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, each word counted once."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    key, size = ids[:n], len(known)
    for k in range(1, width):
        if size * len(known) >= 2**62:  # ranks instead of products: the window keys stay exact
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key, size = key * len(known) + ids[k : k + n], size * len(known)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(_SEPARATORS)]
    chars = len(raw.translate(None, _SEPARATORS).decode())
    return len(words), chars, len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def limits_for(size: int, bands) -> tuple[float, float]:
    return next((low, high) for top, low, high in bands if top is None or size <= top)


def compression(raw: bytes, compressor, bands, chunk: int, chunk_limits, chunk_share: float) -> tuple[float | None, int, int, bool]:
    """``ratio, n_chunks, n_bad_chunks, inside``; an empty text has no ratio and is not inside."""
    if not raw:
        return None, 0, 0, False
    ratio = len(compressor.compress(raw)) / len(raw)
    low, high = limits_for(len(raw), bands)
    starts = list(range(0, len(raw) - chunk + 1, chunk))
    count = len(starts)
    if count and len(raw) % chunk:
        starts.append(len(raw) - chunk)
    bad = sum(not chunk_limits[0] <= len(compressor.compress(raw[s : s + chunk])) / chunk <= chunk_limits[1] for s in starts)
    return ratio, count, bad, low <= ratio <= high and bad <= chunk_share * len(starts)


def verdict(
    text: Column, bands=BANDS, chunk: int = CHUNK_BYTES, chunk_limits=CHUNK_LIMITS, chunk_share: float = CHUNK_SHARE, level: int = LEVEL,
) -> Column:
    """A struct column for a text column: word and line counts, ``ratio`` of the whole text, ``n_chunks`` of
    ``chunk`` bytes, ``n_bad_chunks``, ``base_failed``, ``kept``. Where the chunks leave a rest, the last ``chunk``
    bytes are judged like one more chunk: counted if bad, but not in ``n_chunks``.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated windows of five.
    ``kept``: not failed, the ratio within the limits of the text's length, and at most ``chunk_share`` of
    the judged chunks outside ``chunk_limits``. Whole texts are compressed, one at a time. A NULL text counts as
    empty: no words, ``ratio`` NULL, failed.
    """

    def judged(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        rows = []
        for text in each(texts):
            raw = text.encode()
            counts = base_counts(raw)
            ratio, parts, bad, inside = compression(raw, compressor, bands, chunk, chunk_limits, chunk_share)
            failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
            rows.append((*counts, ratio, parts, bad, failed, inside and not failed))
        columns = zip(*rows) if rows else [[]] * len(_FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, _, t) in zip(columns, _FIELDS)], names=[n for n, _, _ in _FIELDS])

    judged.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(judged, ", ".join(f"{n} {sql}" for n, sql, _ in _FIELDS))(text)


_FIELDS = [
    *[(n, "bigint", pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    ("ratio", "double", pa.float64()), ("n_chunks", "bigint", pa.int64()), ("n_bad_chunks", "bigint", pa.int64()),
    ("base_failed", "boolean", pa.bool_()), ("kept", "boolean", pa.bool_()),
]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``doc_id`` and the fields of :func:`verdict`, one row per input row. Rows are judged alone: repeated
    rows get the same verdict, ids may be NULL, further columns are ignored."""
    return docs.select(col(id_col).alias("doc_id"), verdict(col(text_col), **limits).alias("v")).select("doc_id", "v.*")


def passing(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return docs.where(verdict(col(text_col), **limits)["kept"])
