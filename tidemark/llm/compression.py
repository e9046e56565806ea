"""Quality rules with compression bands.

The base rules count words, symbols, repeated lines and repeated word windows. The
bands compare Zstandard ratios (compressed bytes over bytes) with limits that
depend on the length: of the whole text, and of fixed chunks, the last of which holds what is
left over. Text below its band
repeats itself, text above it is noise. A text goes if it is outside as a whole or
if most of its full chunks are.

A null text has no word. Rows are judged alone, so ties, repeated rows, other
columns and empty tables change nothing; texts of any length are read whole.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, texts_of

LEVEL = 3
CHUNK = 4096
#: From so many bytes on, the least and the largest ratio of a text that is kept.
BANDS = ((0, 0.0, 9.9), (200, 0.25, 1.0), (500, 0.20, 0.90), (1000, 0.16, 0.85),
         (2000, 0.13, 0.80), (4000, 0.10, 0.75), (16000, 0.08, 0.72))
CHUNK_BAND = (0.12, 0.75)
CHUNK_SHARE = 0.5
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
          "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
          "ratio double, n_chunks bigint, n_chunks_outside bigint")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of so many words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, window):
        # Renumber when the next product could leave 63 bits.
        top = int(code.max()) + 1
        if top * len(numbers) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(numbers) + ids[k:n + k]
    _, where, times = np.unique(code, return_inverse=True, return_counts=True)
    again = times[where] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= again
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, again = set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            again += line in seen
            seen.add(line)
    return again


def band(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def measure(raw: bytes, compress) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, chunks, those outside their band, and the verdict."""
    if not raw:
        return 1.0, 0, 0, True
    ratio = len(compress(raw)) / len(raw)
    low, high = band(len(raw))
    outside = chunks = 0
    for start in range(0, len(raw) - CHUNK + 1, CHUNK):
        chunks += 1
        # What is left behind the last full chunk belongs to it.
        part = raw[start:start + CHUNK] if len(raw) - start >= 2 * CHUNK else raw[start:]
        outside += not CHUNK_BAND[0] <= len(compress(part)) / len(part) <= CHUNK_BAND[1]
    return ratio, chunks, outside, low <= ratio <= high and outside <= CHUNK_SHARE * chunks


def judge(text: str, compress) -> dict:
    raw = text.encode()
    words = raw.split()  # on the six ASCII white-space bytes
    repeat = repeated_words(words)
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    ratio, chunks, outside, fits = measure(raw, compress)
    return {"n_words": len(words), "word_chars": len(text) - sum(map(text.count, SPACES)),
            "n_symbols": sum(raw.count(s) for s in SYMBOLS), "n_dup_lines": repeated_lines(raw),
            "n_repeat_words": repeat, "base_failed": failed, "kept": fits and not failed,
            "ratio": ratio, "n_chunks": chunks, "n_chunks_outside": outside}


def quality(docs: DataFrame) -> DataFrame:
    """Base counts, compression ratios and the verdict for every whole text."""
    def make():
        compress = zstandard.ZstdCompressor(level=LEVEL).compress

        def work(batch):
            rows = [judge(t, compress) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"),
                    **{name: [r[name] for r in rows] for name in (rows[0] if rows else ())}}
        return work
    return map_texts(texts_of(docs), SCHEMA, make)
