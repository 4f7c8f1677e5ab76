"""Fill-in-the-middle by a wavelet matrix over character classes.

Every character of a text has one of four classes: line end, other ASCII white space,
sentence mark, anything else. A unit is named by the classes that close it (a line by the line
end, a sentence by line end or mark, ...), so the number of whole units in the first i
characters is the sum of these classes' ranks at i. A wavelet matrix answers a rank in one
step per level; a cut after u units is the u-th closing character, found by select where one class
closes the unit and by bisection on the summed ranks where several do. Both cuts of a text come
from hashes of seed and doc_id, so a retry cuts alike.

Form: plain where the text is empty or holds a sentinel, or where it's not drawn; otherwise
``spm`` (suffix first) or ``psm``.

Defined cases: a null text is the empty text, which is plain with no units; a null doc_id is
hashed as the empty text; an unclosed last unit counts as one; repeated rows give equal
rows; texts are cut whole, whatever their length; extra columns are ignored; an empty table
stays empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import workers_ready

SEED = 7
#: Percent of texts to transform, and of these the percent with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
PREFIX, SUFFIX, MIDDLE = SENTINELS = "<P>", "<S>", "<M>"
LINE_END, BLANK, MARK, OTHER = range(4)
#: Classes whose characters close a unit.
UNITS = {"line": (LINE_END,), "word": (LINE_END, BLANK), "sentence": (LINE_END, MARK), "char": (LINE_END, BLANK, MARK, OTHER)}
LEVELS = 2


def classes_of(text: str):
    """The class of each code point."""
    import numpy as np
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    table = np.full(129, OTHER, np.uint8)
    table[[9, 11, 12, 13, 32]] = BLANK
    table[[ord(c) for c in ".!?"]] = MARK
    table[10] = LINE_END
    return table[np.minimum(points, 128)]


class Bits:
    """A bit vector with the number of ones before each word of 64 bits."""

    def __init__(self, bits):
        import numpy as np
        packed = np.packbits(bits, bitorder="little").tobytes()
        self.words = np.frombuffer(packed + bytes(16 - len(packed) % 8), "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: int) -> int:
        """Ones among the first i bits."""
        inside = int(self.words[i >> 6]) & ((1 << (i & 63)) - 1)
        return int(self.before[i >> 6]) + inside.bit_count()

    def find(self, k: int, one: bool) -> int:
        """Place of the k-th (from 1) one, or zero."""
        import numpy as np
        before = self.before if one else 64 * np.arange(len(self.before)) - self.before
        at = int(np.searchsorted(before, k)) - 1
        word, left = int(self.words[at]), k - int(before[at])
        for place in range(64):
            left -= (word >> place & 1) == one
            if not left:
                return 64 * at + place
        raise IndexError(k)


class WaveletMatrix:
    """Rank and select of small symbols: one bit vector per level, zeros moved before ones."""

    def __init__(self, symbols, levels: int = LEVELS):
        import numpy as np
        self.size, self.levels = len(symbols), []
        for shift in range(levels - 1, -1, -1):
            ones = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(ones), self.size - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _down(self, symbol: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for shift, bits, zeros in self.levels:
            a, b = bits.ones(lo), bits.ones(hi)
            lo, hi = (zeros + a, zeros + b) if symbol >> shift & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, i: int) -> int:
        """How often the symbol stands among the first i."""
        lo, hi = self._down(symbol, i)
        return hi - lo

    def select(self, symbol: int, k: int) -> int:
        """Place of the symbol's k-th occurrence (from 1)."""
        at = self._down(symbol, 0)[0] + k - 1
        for shift, bits, zeros in reversed(self.levels):
            one = bool(symbol >> shift & 1)
            at = bits.find(at - zeros + 1 if one else at + 1, one)
        return at


class Boundaries:
    """Units of a text: how many there are, and where the first u of them end."""

    def __init__(self, text: str, unit: str = "line"):
        symbols = classes_of(text)
        self.closing, self.size = UNITS[unit], len(symbols)
        self.matrix = WaveletMatrix(symbols)
        self.whole = self.upto(self.size)
        self.n = self.whole + int(self.size > 0 and int(symbols[-1]) not in self.closing)

    def upto(self, i: int) -> int:
        """Units that end within the first i characters."""
        return sum(self.matrix.rank(c, i) for c in self.closing)

    def cut(self, u: int) -> int:
        """Characters in the first u units."""
        if u == 0:
            return 0
        if u > self.whole:
            return self.size
        if len(self.closing) == 1:
            return self.matrix.select(self.closing[0], u) + 1
        lo, hi = u, self.size
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.upto(mid) >= u else (mid + 1, hi)
        return lo


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def transformed(text: str, doc_id: int | None, unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED):
    """n, form, prefix and middle lengths (none if plain) and the output of one text."""
    units = Boundaries(text, unit)
    h = draws(doc_id, seed)
    if not text or any(s in text for s in SENTINELS) or h[2] % 100 >= rate:
        return units.n, "plain", None, None, text
    first, last = sorted((h[0] % (units.n + 1), h[1] % (units.n + 1)))
    a, b = units.cut(first), units.cut(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return units.n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return units.n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, text -> doc_id, n (units), form, prefix_chars, middle_chars, output; one row per document."""
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {sorted(UNITS)}")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = [transformed(t or "", d, unit, rate, suffix_first, seed)
                    for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
            n, form, prefix, middle, out = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    workers_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from.

    A text that is cut holds no sentinel, and no sentinel can begin inside a piece and end in the
    next, so the first place of each one is its own.
    """
    size = len(PREFIX)

    def between(left: str, right: str | None) -> Column:
        start = F.instr(output, F.lit(left)) + size
        return F.substr(output, start) if right is None else F.substr(output, start, F.instr(output, F.lit(right)) - start)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
