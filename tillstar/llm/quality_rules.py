"""Quality rules: zstandard ratios over whole documents and fixed chunks, in bands.

Repetitive text compresses too well and noise too badly. How well clean text compresses
depends on its length, so the limits do too: `LIMITS` gives the least and the greatest
ratio (compressed to plain UTF-8 bytes) at some lengths, and lengths between them get
limits interpolated over the logarithm of the length. A document is rejected where its
whole text is outside its band, or where over half the bytes of its fixed chunks lie in
chunks outside theirs.

The limits were set on prose in Latin script. In UTF-8 other scripts spend two or three
bytes on a letter, all but the last nearly constant, and compress far better. So the bands
judge the text with its letters at about the bytes they are worth (`folded`): one for
alphabets and abugidas, two for kana and syllabaries, three as ever for Han. Text without
such letters is judged as it is; `ratio` is that of the plain UTF-8 bytes in any script.

Beside the bands stand counts on words and lines, and a base rule on them (too few words,
or too large a share of words in repeated three-word windows). Words are what white space
parts. `kept` is false wherever the base rule fails. `usable`, by which `keep_quality` keeps
rows, differs for scripts that don't part words: such a text has enough words if it has so
many pieces of two letters (four in Thai, Lao, Burmese and Khmer).

Null and empty texts have no words and fail the base rule; repeated rows are judged each
for itself; an empty table gives an empty one; input columns all stay.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tillstar.llm.common import with_text_column

#: bytes -> (least, greatest) ratio of clean prose at zstandard level 3, folded.
LIMITS = (
    (64, 0.30, 1.40),
    (256, 0.40, 1.05),
    (512, 0.52, 0.90),
    (1024, 0.49, 0.80),
    (2048, 0.46, 0.75),
    (4096, 0.435, 0.72),
    (8192, 0.41, 0.70),
    (16384, 0.38, 0.70),
    (65536, 0.33, 0.70),
    (262144, 0.28, 0.70),
)
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

# Code points, from and to, of letters worth one byte and two.
ONE_BYTE = (
    (0x370, 0x11FF), (0x1680, 0x1DFF), (0x1F00, 0x1FFF), (0x2C00, 0x2DFF), (0xA640, 0xA69F), (0xA800, 0xABFF),
    (0xFB13, 0xFDFF), (0xFE70, 0xFEFC), (0x10280, 0x11FFF), (0x1E800, 0x1E95F),
)
TWO_BYTES = ((0x1200, 0x167F), (0x3000, 0x318F), (0xA000, 0xA4CF), (0xAC00, 0xD7A3), (0xFF00, 0xFFEF))
#: Code point -> its bytes, each over 127, as surrogates that stand for them.
FOLDED = {c: chr(0xDC80 | c & 0x7F) for a, b in ONE_BYTE for c in range(a, b + 1)} | {
    c: chr(0xDC80 | c >> 7 & 0x7F) + chr(0xDC80 | c & 0x7F) for a, b in TWO_BYTES for c in range(a, b + 1)
}
FOLDS = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ONE_BYTE + TWO_BYTES) + "]")
#: About a word in a script without spaces between words.
UNSPACED = re.compile("[\u3005-\u3007\u3041-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]{1,2}|[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF]{1,4}")

RESULT = StructType([
    *(StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()),
    StructField("ratio", DoubleType()),
    StructField("bad_chunk_share", DoubleType()),
    StructField("usable", BooleanType()),
])


@dataclass(frozen=True)
class Bands:
    """Parameters of the rule; see the module's text."""

    limits: tuple = LIMITS
    level: int = 3
    chunk_bytes: int = 2048
    bad_chunk_share: float = 0.5
    least_words: int = 50
    repeat_percent: int = 50

    def at(self, size: int) -> tuple[float, float]:
        """The band of a text of `size` bytes."""
        k = bisect_right(self.limits, size, key=lambda x: x[0])
        if k == 0 or k == len(self.limits):
            return self.limits[max(0, k - 1)][1:]
        (a, *low), (b, *high) = self.limits[k - 1], self.limits[k]
        share = math.log(size / a) / math.log(b / a)
        return tuple(x + share * (y - x) for x, y in zip(low, high, strict=True))

    def outside(self, ratio: float, size: int) -> bool:
        least, most = self.at(size)
        return not least <= ratio <= most


def counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(WHITE):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated = 0
    if len(times) < len(windows):
        at = [i for i, w in enumerate(windows) if times[w] > 1]
        repeated = 3 + sum(min(3, b - a) for a, b in zip(at, at[1:], strict=False))
    return len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), again, repeated


def folded(text: str, data: bytes) -> bytes:
    """What the bands judge of a text; `data` are its UTF-8 bytes."""
    if text.isascii() or not FOLDS.search(text):
        return data
    return text.translate(FOLDED).encode("utf-8", "surrogateescape")


def judge(bands: Bands):
    """A function from texts to rows of RESULT."""
    packer = zstandard.ZstdCompressor(level=bands.level)

    def one(text: str) -> dict:
        data = text.encode()
        words = data.split()
        chars, symbols, again, repeated = counts(text, words)
        repeats = 100 * repeated > bands.repeat_percent * len(words)
        short = len(words) < bands.least_words
        failed = short or repeats
        if short and not text.isascii():
            short = len(UNSPACED.sub(" w ", text).encode().split()) < bands.least_words
        size = len(data)
        ratio = len(packer.compress(data)) / size if size else 1.0
        use = folded(text, data)
        judged = ratio if use is data else len(packer.compress(use)) / len(use)
        bad = 0
        for at in range(0, len(use), bands.chunk_bytes):
            chunk = use[at : at + bands.chunk_bytes]
            if bands.outside(len(packer.compress(chunk)) / len(chunk), len(chunk)):
                bad += len(chunk)
        share = bad / len(use) if size else 0.0
        clean = not bands.outside(judged, len(use)) and share <= bands.bad_chunk_share if size else False
        return {
            "n_words": len(words), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": again,
            "n_repeat_words": repeated, "base_failed": failed, "kept": clean and not failed,
            "ratio": ratio, "bad_chunk_share": share, "usable": clean and not short and not repeats,
        }

    return lambda texts: [one(t) for t in texts]


def quality_rules(df: DataFrame, text: str = "text", bands: Bands | None = None) -> tuple[DataFrame, str]:
    """`df` with a struct column (its name is returned too) of the counts, the base rule's
    verdict, the ratios, `kept` and `usable`."""
    use = bands or Bands()
    return with_text_column(df, text, "quality", RESULT, lambda: judge(use))


def keep_quality(df: DataFrame, text: str = "text", bands: Bands | None = None) -> DataFrame:
    """The rows of `df` that are usable."""
    judged, at = quality_rules(df, text, bands)
    return judged.where(F.col(at)["usable"]).drop(at)
