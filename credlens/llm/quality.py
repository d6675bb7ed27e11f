"""Quality rules by compression bands.

A text that repeats itself compresses far better than prose of its length, random junk far
worse.  Each whole text and each fixed chunk of it, the tail included, is compressed with
zstandard; a ratio (raw / compressed bytes) outside the band of its length class rejects the
text.  The lower limits come from the ratios of the corpus' own texts that pass the base rules
(word counts, repeated 3-word windows), by length; fixed limits hold below them.

Hex below about 4 kB and random letters below about 2 kB compress as well as some prose of their
length, and digits do at any length: no ratio tells them from prose, so they stay.

Null and empty texts have no words: every count 0, ``base_failed`` true, ``kept`` false.  Long texts are
judged whole and chunk by chunk.  Repeated rows are judged alike (there are no ties to break); extra
input columns, whatever their names, are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlens.llm.common import map_text

SYMBOLS = re.compile(r"[#*$%&|<>]")


@dataclass(frozen=True)
class Band:
    """Allowed compression ratio for texts of at least ``min_bytes`` bytes."""
    min_bytes: int
    low: float
    high: float


#: Whole documents, whatever the corpus.  Short texts barely compress and the frame costs bytes, so
#: the lower limit falls and the upper limit rises with length.  Base64 reaches 1.13 at 300 bytes, 1.24
#: at 600 and 1.38 at 20 kB; a line repeated over and over exceeds 6.
DOC_BANDS = (Band(0, 0.0, 6.0), Band(256, 1.15, 6.0), Band(512, 1.27, 6.0), Band(1024, 1.36, 6.0), Band(2048, 1.40, 7.0),
             Band(16384, 1.42, 8.0))
#: Chunks of ``CHUNK`` bytes, the last one ending with the text; the share of chunks outside the band counts.
CHUNK = 4096
CHUNK_BAND = Band(CHUNK, 1.40, 8.0)
MAX_BAD_CHUNKS = 0.1
#: Classes of length in an octave; a shorter class counts so much less with each class between.
CLASSES, FADE = 2, 0.25
#: A lower limit lies so many times the distance from the median to the highest quarter below the median.
SPREADS = 7.0
#: The chunks' place among the length classes.
CHUNKS = -1
LEVEL = 3

OUT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
       "base_failed boolean, kept boolean, zstd_ratio double, bad_chunk_share double")


def word_rules(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() splits on exactly [\x20\x09-\x0D]
    n = len(words)
    if not n:
        return 0, 0, len(SYMBOLS.findall(text)), 0, 0
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(grams)) < len(grams):
            seen, twice = set(), set()
            for g in grams:
                (twice if g in seen else seen).add(g)
            end = 0  # first word not counted yet
            for i, g in enumerate(grams):
                if g in twice:
                    repeat += i + 3 - max(end, i)
                    end = i + 3
    return n, len(text) - spaces, len(SYMBOLS.findall(text)), dup_lines, repeat


def ratios(raw: bytes, packer) -> tuple[float, list[float]]:
    """(ratio of the whole text, ratios of its chunks; the last one ends with the text)."""
    if not raw:
        return 0.0, []
    whole = len(raw) / len(packer.compress(raw))
    starts = [*range(0, len(raw) - CHUNK + 1, CHUNK)]
    if len(raw) > CHUNK and len(raw) % CHUNK:
        starts.append(len(raw) - CHUNK)
    return whole, [CHUNK / len(packer.compress(raw[i:i + CHUNK])) for i in starts]


def length_class(size: int) -> int:
    return int(CLASSES * math.log2(size)) if size else 0


def in_band(size: int, ratio: float, bands=DOC_BANDS, low: float = 0.0) -> bool:
    band = [b for b in bands if size >= b.min_bytes][-1]
    return max(low, band.low) <= ratio <= band.high


def _packer():
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)


def _failed(n: int, repeat: int) -> bool:
    return n < 50 or 100 * repeat > 50 * n


def measure(texts: list[str | None]) -> dict:
    """Length classes and ratios of the texts that pass the base rules, with those of their chunks."""
    packer = _packer()
    classes, whole, parts = [], [], []
    for t in texts:
        n, _, _, _, repeat = word_rules(t or "")
        raw = (t or "").encode("utf-8", "surrogatepass")
        ratio, own = (None, None) if _failed(n, repeat) else ratios(raw, packer)
        classes.append(length_class(len(raw)))
        whole.append(ratio)
        parts.append(own)
    return {"size_class": classes, "ratio": whole, "chunks": parts}


def lower_limits(df: DataFrame, text_col: str = "text") -> dict[int, float]:
    """Lower limit of each length class, of chunks under ``CHUNKS``, from all texts that pass the base rules."""
    found = map_text(df, measure, "size_class bigint, ratio double, chunks array<double>", text_col, carry=()).where("ratio is not null")
    one = F.array(F.struct(F.col("size_class").alias("of"), F.col("ratio").alias("ratio")))
    more = F.transform("chunks", lambda c: F.struct(F.lit(CHUNKS).cast("bigint").alias("of"), c.alias("ratio")))
    each = found.select(F.explode(F.concat(one, more)).alias("x")).select("x.*")
    rows = each.groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("ratio", [0.5, 0.75], 10_000).alias("q")).collect()
    return smoothed({r["of"]: (r["n"], *r["q"]) for r in rows})


def smoothed(classes: dict[int, tuple[int, float, float]]) -> dict[int, float]:
    """Lower limits from (texts, median, upper quartile) of each length class.

    Only the upper half tells the spread, one for all lengths: junk lies below, and while less than half
    of the texts are junk it can neither widen the spread much nor pull a limit down to itself.  Ratios
    grow with length: a class takes the mean of its own median and those of all shorter ones, weighted by
    texts and fading with distance, so a thin class leans on its neighbour and none changes its rule
    at some number of texts."""
    limits = {CHUNKS: 0.0}
    if CHUNKS in classes:
        _, median, upper = classes[CHUNKS]
        limits[CHUNKS] = median - SPREADS * (upper - median)
    whole = [c for k, c in classes.items() if k != CHUNKS]
    spread = sum(n * (upper - median) for n, median, upper in whole) / max(1, sum(n for n, _, _ in whole))
    n = middle = 0.0
    for k in range(length_class(1 << 40)):
        own, median, _ = classes.get(k, (0, 0.0, 0.0))
        n, middle = FADE * n + own, FADE * middle + own * median
        limits[k] = middle / n - SPREADS * spread if n else 0.0
    return limits


def judge(texts: list[str | None], limits: dict[int, float] | None = None) -> dict:
    packer, limits = _packer(), limits or {}
    rows = []
    for t in texts:
        t = t or ""
        n, chars, symbols, dup, repeat = word_rules(t)
        raw = t.encode("utf-8", "surrogatepass")
        ratio, parts = ratios(raw, packer)
        outside = sum(not in_band(CHUNK, r, (CHUNK_BAND,), limits.get(CHUNKS, 0.0)) for r in parts)
        bad = outside / len(parts) if parts else 0.0
        failed = _failed(n, repeat)
        kept = not failed and in_band(len(raw), ratio, low=limits.get(length_class(len(raw)), 0.0)) and bad <= MAX_BAD_CHUNKS
        rows.append((n, chars, symbols, dup, repeat, failed, kept, ratio, bad))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "zstd_ratio", "bad_chunk_share")
    return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))


def quality_rules(df: DataFrame, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """Counts, compression ratios and the verdict of every whole text.  Two passes: one number per
    length class is learned from all texts, then each text is judged where it lies."""
    limits = lower_limits(df, text_col)
    return map_text(df, lambda texts: judge(texts, limits), OUT, text_col, carry)
