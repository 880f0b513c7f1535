"""Quality rules on compressed size.

A text is compressed by zstandard as a whole and in fixed chunks.  Repetitive
text compresses too well, encoded or random text too badly; both limits depend on
the length, as a short text cannot fill the compressor's window.  The limits were
set from labelled rows: outside everything that good documents of a length reach,
with a margin.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from titleprep.llm.common import add_columns, texts, word_lists

# bytes from which a row holds, least and greatest ratio of compressed to plain size
LIMITS = (
    (0, 0.00, 9.00),
    (200, 0.40, 1.00),
    (400, 0.45, 0.85),
    (800, 0.43, 0.75),
    (1_600, 0.41, 0.70),
    (3_200, 0.39, 0.65),
    (6_400, 0.37, 0.62),
    (12_800, 0.34, 0.60),
    (51_200, 0.30, 0.60),
)
CHUNK_LIMITS = (0.30, 0.75)
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"


def _repeated_words(ids: np.ndarray) -> int:
    """Words inside three-word windows that are found twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    # equal pairs get equal numbers, then equal triples
    _, pairs = np.unique(ids[:-1].astype(np.int64) << 32 | ids[1:], return_inverse=True)
    _, place, count = np.unique(
        pairs[:-1].astype(np.int64) << 32 | ids[2:], return_inverse=True, return_counts=True
    )
    starts = np.zeros(n + 3, np.int64)
    hit = count[place] > 1
    starts[:n] += hit
    starts[3:] -= hit
    return int(np.count_nonzero(np.cumsum(starts[: n + 2])))


def _measures(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    numbers: dict[bytes, int] = {}
    parts = [
        np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        for words in word_lists(data)
    ]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    solid = data.translate(None, _SPACE)
    chars = len(solid) - np.count_nonzero(np.frombuffer(solid, np.uint8) & 0xC0 == 0x80)
    symbols = sum(map(data.count, (bytes([s]) for s in _SYMBOLS)))
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    return len(ids), int(chars), symbols, len(lines) - len(set(lines)), _repeated_words(ids)


def _ratios(data: bytes, chunk: int, press) -> tuple[float | None, float]:
    """Ratio of the whole, and the share of whole chunks outside the limits for chunks."""
    if not data:
        return None, 0.0
    low, high = CHUNK_LIMITS
    whole = [len(press(data[at : at + chunk])) / chunk for at in range(0, len(data) - chunk + 1, chunk)]
    odd = sum(not low <= ratio <= high for ratio in whole)
    return len(press(data)) / len(data), odd / len(whole) if whole else 0.0


@dataclass(frozen=True)
class CompressionBands:
    """Adds the measures and ``kept`` to documents; the columns of the documents stay.

    A document fails when it has under ``min_words`` words, when over half of its
    words stand in repeated three-word windows, when the ratio of the whole text is
    outside LIMITS, or when over ``odd_share`` of its whole chunks are outside
    CHUNK_LIMITS.  Null text has no words and fails.  Columns that have the names
    of the measures are replaced.  Every row is judged by itself, so repeated rows
    and ties need no rule; an empty table gives an empty table.
    """

    min_words: int = 50
    chunk_bytes: int = 4_096
    odd_share: float = 0.5
    level: int = 3
    text_col: str = "text"

    def __call__(self, docs: DataFrame) -> DataFrame:
        def judge(batch):
            press = zstandard.ZstdCompressor(level=self.level).compress
            rows = []
            for data in texts(batch, self.text_col):
                n, chars, symbols, lines, repeats = _measures(data)
                failed = n < self.min_words or 100 * repeats > 50 * n
                ratio, odd = _ratios(data, self.chunk_bytes, press)
                low, high = next((lo, hi) for size, lo, hi in reversed(LIMITS) if len(data) >= size)
                fits = ratio is not None and low <= ratio <= high and odd <= self.odd_share
                rows.append((n, chars, symbols, lines, repeats, failed, not failed and fits, ratio, odd))
            columns = zip(*rows) if rows else [()] * len(new)
            return {
                f.name: pa.array(c, pa.int64() if i < 5 else pa.bool_() if i < 7 else pa.float64())
                for i, (f, c) in enumerate(zip(new.fields, columns))
            }

        long = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        new = StructType(
            list(
                chain(
                    (StructField(c, LongType()) for c in long),
                    (StructField(c, BooleanType()) for c in ("base_failed", "kept")),
                    (StructField(c, DoubleType()) for c in ("zstd_ratio", "odd_chunks")),
                )
            )
        )
        return add_columns(docs, judge, new)
