"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on whole Arrow string columns: words are found and hashed with
a handful of numpy passes over the UTF-8 bytes, so no Python code runs per
character or per word.  Nulls count as empty texts.

Code points beyond ASCII are told apart by their Unicode category: white space and
punctuation end a word, and each character of a script that puts no spaces between
words is a word, as is each symbol.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.RandomState(20240607)
_BYTE = _RNG.randint(0, 2**62, 256).astype(np.uint64) * np.uint64(4) + np.uint64(1)
_ROOT = 0x9E3779B97F4A7C15 | 1
_ROOT_INV = pow(_ROOT, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}

#: What a character is: between words, part of one, one by itself, or part of what stands before it.
_GAP, _PART, _ALONE, _MARK = 0, 1, 2, 3
#: ASCII letters and digits make up a word; what other characters are, ``_kinds`` says.
_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[[c for c in range(256) if c >= 128 or chr(c).isalnum()]] = True
#: Blocks of scripts without spaces between words: Thai and Lao, Myanmar, Khmer, Tai, Balinese, Han with kana,
#: bopomofo and Yi, Javanese to Tai Viet, half-width kana, cuneiform, hieroglyphs, Tangut, Khitan, Nushu, Han beyond the BMP.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF),
    (0xA980, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x12000, 0x1254F), (0x13000, 0x1345F), (0x14400, 0x1467F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
]
#: Invisible characters that end a word: zero-width space, byte order mark, directions.
_SPLITTING = {0x200B, 0xFEFF, 0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2060, 0x206A)}
_NONSPACE = np.ones(256, bool)
_NONSPACE[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _kinds() -> np.ndarray:
    """What each code point is; those that Unicode leaves open are parts of words."""
    kinds = np.full(0x110000, _PART, np.uint8)
    for first, last in _UNSPACED:
        kinds[first : last + 1] = _ALONE
    for c in [*range(0x80, 0x20000), *range(0xE0000, 0xE0200)]:
        k = unicodedata.category(chr(c))
        if k[0] in "ZP" or k in ("Cc", "Sk") or c in _SPLITTING:
            kinds[c] = _GAP
        elif k[0] == "M" or k == "Cf":
            kinds[c] = _MARK
        elif k[0] == "S":
            kinds[c] = _ALONE
    return kinds


def _beyond_ascii(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are not part of a word, by their characters; and where a word ends or begins without a gap.

    Bytes that aren't UTF-8 are parts of words.
    """
    n = len(raw)
    padded = np.append(raw, np.zeros(4, np.uint8))
    first = np.zeros(n + 4, bool)
    first[off] = True
    at = np.flatnonzero(raw >= 0xC2)
    lead = raw[at]
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
    point = (lead & (0xFF >> (size + 1)).astype(np.uint8)).astype(np.int64)
    whole = lead < 0xF5
    for k in (1, 2, 3):
        more = size > k
        byte = padded[at + k]
        whole &= ~more | (((byte & 0xC0) == 0x80) & ~first[at + k])
        point = np.where(more, point << 6 | (byte & 0x3F), point)
    whole &= point < 0x110000
    at, size = at[whole], size[whole]
    kind = _kinds()[point[whole]]
    gap = np.zeros(n + 4, bool)
    for k in (0, 1, 2, 3):
        gap[(at + k)[(kind == _GAP) & (size > k)]] = True
    if not len(at):
        return gap[:n], at
    # a mark belongs to the character right before it
    tied = np.zeros(len(at), bool)
    tied[1:] = (kind[1:] == _MARK) & (at[:-1] + size[:-1] == at[1:]) & ~first[at[1:]]
    head = np.flatnonzero(~tied)
    last = np.append(head[1:], len(at)) - 1
    alone = kind[head] == _ALONE
    return gap[:n], np.concatenate([at[head[alone]], (at + size)[last[alone]]])


def _powers(root: int, n: int) -> np.ndarray:
    have = _POWERS.get(root)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        factors = np.full(size, root, np.uint64)
        factors[0] = 1
        have = _POWERS[root] = np.multiply.accumulate(factors)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection), so that every bit depends on every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``values[starts:ends]`` for every range, independent of its place."""
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_ROOT, n), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * _powers(_ROOT_INV, n + 1)[starts]


@dataclass
class Words:
    """Words of some consecutive texts, in order.

    ``bounds[i]:bounds[i+1]`` are text i's words; ``start`` and ``end`` are byte
    offsets within that text; ``hash`` depends on the word alone.
    """

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words that begin at each word, and its text's index; only those inside one text."""
        at = self.gram_starts(n)
        return self.gram_hash(at, n), self.doc[at]

    def gram_starts(self, n: int) -> np.ndarray:
        left = self.bounds[1:][self.doc] - np.arange(len(self.hash))
        return np.flatnonzero(left >= n)

    def gram_hash(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(_ranges(self.hash, at, at + n) + np.uint64(n))


def data_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words_of(raw: np.ndarray, off: np.ndarray, exact: bool = False) -> Words:
    """Words of the texts ``raw[off[i]:off[i+1]]``.

    exact: words are runs without ASCII white space, compared byte by byte; else
    runs of letters, marks and digits, with ASCII case folded, and single characters
    of scripts without spaces and symbols beyond ASCII, with the marks on them.
    """
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = (_NONSPACE if exact else _WORDLIKE)[raw]
    cut = off
    if not exact and n and int(raw.max()) >= 128:
        gap, breaks = _beyond_ascii(raw, off)
        inside[1:-1] &= ~gap
        cut = np.unique(np.concatenate([off, breaks]))
    flips = inside[1:] != inside[:-1]
    begins, stops = flips & inside[1:], flips & inside[:-1]
    # a word also ends where its text or a character that is a word ends
    cut = cut[(cut > 0) & (cut < n)]
    cut = cut[inside[cut] & inside[cut + 1]]
    begins[cut] = True
    stops[cut] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    h = mix(_ranges(_BYTE[raw if exact else _LOWER[raw]], start, end)) if n else np.zeros(0, np.uint64)
    bounds = np.searchsorted(start, off)
    base = np.repeat(off[:-1], np.diff(bounds))
    return Words(h, start - base, end - base, bounds)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive parts of a batch whose texts have about ``most`` bytes, at least one text each."""
    raw, off = data_of(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield batch.slice(i, j - i), raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's LONG."""
    return h.view(np.int64)
