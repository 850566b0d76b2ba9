"""Quality rules by compression bands: zstandard ratios of whole documents and fixed chunks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.text import SPACE, keep_rows, map_texts, texts_of

SYMBOLS = b"#*$%&|<>"
#: Distances of the quartiles that limits lie beyond them: Tukey's outer fences.
FENCE = 3.0
#: Steps of a ratio of one in histograms.
STEPS = 4000


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, by length in bytes.

    Short texts give the compressor nothing to refer to, so their ratio is higher; each band is
    ``(shorter than, lowest ratio, highest ratio)``. Running prose lies near 0.6 at 500 bytes and near 0.42 at
    10,000. The limits are ``FENCE`` times the distance of the quartiles below the lower and above the upper one, as
    ``measured`` gives them for all documents of sf0.1 that pass the base rules, labels not read; texts under 256 bytes,
    of which there are none there, have wide limits.
    A chunk is ``chunk`` bytes; a document fails when more than ``bad_chunks`` of its chunks, which cover every byte of
    a text of at least one chunk, lie outside the chunk limits. Texts under ``shortest`` bytes are left to the base rules.
    """

    level: int = 3
    shortest: int = 128
    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.40, 1.60),
        (512, 0.497, 0.771),
        (724, 0.498, 0.694),
        (1024, 0.456, 0.648),
        (1448, 0.458, 0.586),
        (2048, 0.450, 0.553),
        (2896, 0.440, 0.527),
        (4096, 0.435, 0.507),
        (5793, 0.428, 0.486),
        (8192, 0.407, 0.486),
        (11585, 0.402, 0.475),
        (16384, 0.374, 0.482),
        (float("inf"), 0.362, 0.468),
    )
    chunk: int = 2048
    chunk_limits: tuple[float, float] = (0.454, 0.529)
    bad_chunks: float = 0.25

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for below, low, high in self.whole if size < below)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that the text has twice or more, the first one included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three ids would not fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    solid = text.translate(None, SPACE)
    n_symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    word_chars = len(solid) - len(solid.translate(None, _FIRST_BYTES)) if not solid.isascii() else len(solid)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words)


#: Every byte that starts a code point in UTF-8.
_FIRST_BYTES = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def ratios(text: bytes, bands: Bands, squeeze: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """The ratio of the whole text and of each chunk. The last chunk ends with the text, over the one before if need be."""
    whole = len(squeeze.compress(text)) / len(text) if text else 1.0
    last = len(text) - bands.chunk
    starts = [*range(0, last, bands.chunk), last] if last >= 0 else []
    return whole, [len(squeeze.compress(text[i : i + bands.chunk])) / bands.chunk for i in starts]


def in_bands(text: bytes, bands: Bands, squeeze: zstandard.ZstdCompressor) -> tuple[bool, float, float]:
    """Whether the text passes, its ratio, and the share of its chunks outside the chunk limits."""
    whole, chunks = ratios(text, bands, squeeze)
    low, high = bands.chunk_limits
    bad = sum(not low <= r <= high for r in chunks) / len(chunks) if chunks else 0.0
    if len(text) < bands.shortest:
        return True, whole, bad
    low, high = bands.limits(len(text))
    return low <= whole <= high and bad <= bands.bad_chunks, whole, bad


def _fences(histogram: dict[int, int]) -> tuple[float, float]:
    """The outer fences of a histogram of ratios."""
    steps = sorted(histogram)
    below = np.cumsum([histogram[k] for k in steps])
    first, third = ((steps[int(np.searchsorted(below, share * below[-1]))] + 0.5) / STEPS for share in (0.25, 0.75))
    return round(first - FENCE * (third - first), 3), round(third + FENCE * (third - first), 3)


def measured(docs: DataFrame, bands: Bands | None = None) -> Bands:
    """The same bands with the limits that all documents passing the base rules give; those without documents stay.

    Ratios are counted in the tasks, so that a few thousand numbers are shuffled whatever the table's size.
    """
    bands = bands or Bands()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, counts = zstandard.ZstdCompressor(level=bands.level), Counter()
        for batch in batches:
            for text in texts_of(batch):
                words = text.split()
                if not base_fails(len(words), repeated_words(words)):
                    whole, chunks = ratios(text, bands, squeeze)
                    counts[next(i for i, (below, _, _) in enumerate(bands.whole) if len(text) < below), int(whole * STEPS)] += 1
                    counts.update((-1, int(r * STEPS)) for r in chunks)
        columns = [[b for b, _ in counts], [k for _, k in counts], list(counts.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["band", "step", "n"])

    found: dict[int, dict[int, int]] = {}
    for r in map_texts(docs, ["text"], "band long, step long, n long", each).groupBy("band", "step").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r["band"], {})[r["step"]] = r["n"]
    whole = tuple((below, *(_fences(found[i]) if i in found else (low, high))) for i, (below, low, high) in enumerate(bands.whole))
    return replace(bands, whole=whole, chunk_limits=_fences(found[-1]) if -1 in found else bands.chunk_limits)


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
)


def report(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """One row per document: base counts, compression ratios and the verdict.

    Needs ``doc_id`` and ``text``. A null text counts as empty (no words: fails the base rules), a null id
    stays null, repeated rows are reported each, an empty table gives no rows. No shuffle.
    """
    bands = bands or Bands()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                counts = base_counts(text)
                good, whole, bad = in_bands(text, bands, squeeze)
                failed = base_fails(counts[0], counts[4])
                rows.append((*counts, failed, good and not failed, whole, bad))
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunk_share"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc_id", *names])

    return map_texts(docs, ["doc_id", "text"], REPORT, each)


def keep_good(docs: DataFrame, bands: Bands | None = None, text: str = "text") -> DataFrame:
    """The rows that pass the base rules and the bands, with all their columns."""
    bands = bands or Bands()

    def verdict():
        squeeze = zstandard.ZstdCompressor(level=bands.level)

        def passes(texts: list[bytes]) -> list[bool]:
            kept = []
            for x in texts:
                words = x.split()
                kept.append(not base_fails(len(words), repeated_words(words)) and in_bands(x, bands, squeeze)[0])
            return kept

        return passes

    return keep_rows(docs, text, verdict)
