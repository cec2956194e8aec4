"""Byte-level BPE encoding and decoding.

The vocabulary's bytes are mapped to Latin-1 characters, so that an Aho-Corasick
automaton over text finds every token that begins at every byte in one pass.  An
encoder then walks from the longest match and backtracks to shorter ones where
two neighbouring tokens could not have survived as neighbours; whether they can
depends on the pair alone and is memoised.  The one sequence all of whose
neighbours are compatible is the one that merging by rank gives, so the result is
exact, and each byte is entered a bounded number of times.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..runtime import arrow_map, held
from .frames import table
from .textkit import _BYTE, _ranges, slices

#: Bytes after a space that can't begin white space.
_OPENS = np.ones(256, bool)
_OPENS[[*range(9, 14), *range(28, 33), 0x85, 0xA0, 0xC2, 0xE1, 0xE2, 0xE3]] = False

#: Signs, none of which is an apostrophe, that the pattern takes as pieces of their own after a word.
_SIGNS = frozenset(bytes([c]) for c in b".,;:!?)]}")

#: The public split pattern of the 50k byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Memoised chunks per worker, and as many pieces of longer chunks; beyond it a memo starts again.
MEMO = 150_000
#: Memoised pairs of neighbouring tokens per worker.
PAIRS = 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class _Memo(dict):
    """Packed tokens by bytes; long ones, which rarely come again, aren't kept."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import ahocorasick

        self.bytes = {r: b for b, r in ranks.items()}
        self.rank = ranks
        self.trie = ahocorasick.Automaton()
        for b, r in ranks.items():
            self.trie.add_word(b.decode("latin-1"), r)
        self.trie.make_automaton()
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.apart: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        for b, r in ranks.items():
            for n in range(len(b) - 1, 0, -1):
                if (p := ranks.get(b[:n])) is not None:
                    self.shorter[r] = p
                    break
        for b, r in sorted(ranks.items(), key=lambda x: x[1]):
            if len(b) > 1 and (halves := self._halves(b, r)):
                self.parts[r] = halves
                self.merged[halves] = r
        self.length = [len(self.bytes.get(r, b"")) for r in range(max(self.bytes) + 1)]
        self.next = [self.shorter.get(r, -1) for r in range(len(self.length))]
        self.find = regex.compile(pattern).findall
        self.pieces = _Memo(self._piece, MEMO)
        self.chunks = _Memo(self._chunk, MEMO)
        self.cuts = pattern == PATTERN
        size = max(self.bytes) + 1
        known = [self.bytes.get(r, b"") for r in range(size)]
        self.flat = np.frombuffer(b"".join(known), np.uint8)
        self.flat_len = np.array([len(b) for b in known], np.int64)
        self.flat_at = np.cumsum(self.flat_len) - self.flat_len

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one: what lower ranks leave of its bytes."""
        seq = [token[i : i + 1] for i in range(len(token))]
        while len(seq) > 2:
            best, at = rank, -1
            for i in range(len(seq) - 1):
                if (r := self.rank.get(seq[i] + seq[i + 1], rank)) < best:
                    best, at = r, i
            if at < 0:
                return None
            seq[at : at + 2] = [seq[at] + seq[at + 1]]
        return self.rank[seq[0]], self.rank[seq[1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between these neighbours; memoised."""
        got = self.apart.get(key := left << 32 | right)
        if got is None:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            got = self.apart[key] = self._fits(left, right)
        return got

    def _fits(self, left: int, right: int) -> bool:
        # Undo the merges of both sides, latest first.  A merge across the border that has
        # a lower rank than the merge last undone would have come before it.
        a, b, bound = left, right, 1 << 60
        while True:
            if self.merged.get((a, b), bound) < bound:
                return False
            halves_a, halves_b = self.parts.get(a), self.parts.get(b)
            if halves_a is None and halves_b is None:
                return True
            if halves_b is None or (halves_a is not None and a > b):
                bound, a = a, halves_a[1]
            else:  # at equal rank the left one merges first, so the border's merge may still tie
                bound, b = b + 1, halves_b[0]

    def _piece(self, piece: bytes) -> bytes:
        whole = self.rank.get(piece)
        return array("i", [whole] if whole is not None else self._walk(piece)).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        if self.cuts:  # a word of ASCII letters, alone or before one sign, is what the pattern finds as well
            word = chunk[1:] if chunk[:1] == b" " else chunk
            if word.isalpha():
                return self._piece(chunk)
            if word[-1:] in _SIGNS and word[:-1].isalpha():
                return self.pieces[chunk[:-1]] + self.pieces[chunk[-1:]]
        found = [p.encode("utf-8", "surrogatepass") for p in self.find(chunk.decode("utf-8", "surrogatepass"))]
        if len(found) == 1:  # the chunk's own entry is enough
            return self._piece(found[0])
        return b"".join(map(self.pieces.__getitem__, found))

    def _walk(self, raw: bytes) -> list[int]:
        n = len(raw)
        length, shorter, apart, fits = self.length, self.next, self.apart, self.fits
        longest = [-1] * n
        for end, r in self.trie.iter(raw.decode("latin-1")):  # by their ends, so the last one of a start is the longest
            longest[end - length[r] + 1] = r
        if -1 in longest:
            raise ValueError("the vocabulary lacks a single byte")
        dead: set[int] = set()  # places from which no way leads on
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            end = at + length[token]
            if last < 0:
                good = True
            else:
                good = apart.get(last << 32 | token)
                if good is None:
                    good = fits(last, token)
            if good and end not in dead:
                out.append(token)
                at, last = end, token
                if at < n:
                    token = longest[at]
                continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._chunk(text.encode("utf-8", "surrogatepass")), np.int32).tolist()

    def encode_many(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the texts ``raw[off[i]:off[i+1]]``, one after the other, and how many each has.

        Under the public pattern a piece begins at every space before a non-space,
        so texts are cut there, and each distinct chunk is encoded once.
        """
        data = raw.tobytes()
        if not self.cuts or len(raw) < 2:
            each = [self._chunk(data[i:j]) for i, j in zip(off[:-1].tolist(), off[1:].tolist())]
            return np.frombuffer(b"".join(each), np.int32), np.array([len(x) // 4 for x in each], np.int64)
        begins = np.zeros(len(raw) + 1, bool)
        begins[:-2] = (raw[:-1] == 32) & _OPENS[raw[1:]]
        begins[off] = True
        at = np.flatnonzero(begins)
        start, end = at[:-1], at[1:]
        _, first, which = np.unique(_ranges(_BYTE[raw], start, end), return_index=True, return_inverse=True)
        made = list(map(self.chunks.__getitem__, [data[i:j] for i, j in zip(start[first].tolist(), end[first].tolist())]))
        size = np.array([len(x) // 4 for x in made], np.int64)
        flat = np.frombuffer(b"".join(made), np.int32)
        sizes = size[which]
        ends = np.cumsum(sizes)
        places = np.repeat((np.cumsum(size) - size)[which] - (ends - sizes), sizes) + np.arange(ends[-1])
        total = np.concatenate([[0], ends])
        return flat[places], np.diff(total[np.searchsorted(start, off)])

    def decode(self, tokens: Iterable[int]) -> bytes:
        """The bytes of the tokens; an unknown token is an error."""
        return b"".join(map(self.bytes.__getitem__, tokens))

    def decode_packed(self, tokens: np.ndarray) -> bytes:
        """Like ``decode``, without a Python object per token."""
        sizes = self.flat_len[tokens]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.flat[np.repeat(self.flat_at[tokens] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()

    def agrees(self, flat: np.ndarray, counts: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """For each text, whether its tokens decode to its bytes."""
        back, want = self.decode_packed(flat), raw.tobytes()
        places = np.concatenate([[0], np.cumsum(self.flat_len[flat])])[np.concatenate([[0], np.cumsum(counts)])]
        if back == want and (places == off).all():
            return np.ones(len(counts), bool)
        spans = zip(places[:-1].tolist(), places[1:].tolist(), off[:-1].tolist(), off[1:].tolist())
        return np.array([back[a:b] == want[i:j] for a, b, i, j in spans], bool)


def codec(packed: bytes, pattern: str) -> Codec:
    """This worker's codec of a packed vocabulary, built once."""
    key, codecs = (zlib.crc32(packed), len(packed), pattern), held(__name__)
    if key not in codecs:
        rows = (x.split() for x in zlib.decompress(packed).splitlines())
        codecs[key] = Codec({base64.b64decode(a): int(b) for a, b in rows}, pattern)
    return codecs[key]


def pack(ranks: dict[bytes, int]) -> bytes:
    return zlib.compress(b"\n".join(b"%s %d" % (base64.b64encode(b), r) for b, r in ranks.items()))


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("round_trip", T.BooleanType()),
])
_ARROW = pa.schema([("doc_id", pa.int64()), ("tokens", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("round_trip", pa.bool_())])


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, tokens, n_tokens, n_bytes, round_trip)``, one row per row of ``docs``.

    The vocabulary file is read on the driver and broadcast (its size is fixed by
    the tokenizer).  No shuffle.  A null text gives null tokens and counts and a
    null round_trip, an empty one an empty list; null ids stay null; repeated rows are encoded each,
    very long texts as a whole;
    other columns are not read.  round_trip tells whether decoding the tokens
    gave the text's bytes again.
    """
    packed = docs.sparkSession.sparkContext.broadcast(pack(load_ranks(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(packed.value, pattern)
        for batch in batches:
            for part, raw, off in slices(batch, "text", 1 << 18):
                empty = part.column(1).is_null().to_numpy(zero_copy_only=False)
                flat, counts = c.encode_many(raw, off)
                same = c.agrees(flat, counts, raw, off)
                if not same.all():  # two chunks with one hash: each text by itself
                    each = [c.encode_many(raw[i:j], np.array([0, j - i])) for i, j in zip(off[:-1], off[1:])]
                    flat = np.concatenate([x for x, _ in each])
                    counts = np.concatenate([k for _, k in each])
                    same = c.agrees(flat, counts, raw, off)
                ends = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat), mask=pa.array(empty))
                columns = [part.column(0), lists, pa.array(counts, mask=empty), pa.array(np.diff(off), mask=empty), pa.array(same, mask=empty)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return arrow_map(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")), run, SCHEMA)


DECODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, tokens)``; null tokens give null, bytes that are not UTF-8 become U+FFFD."""
    packed = encoded.sparkSession.sparkContext.broadcast(pack(load_ranks(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(packed.value, pattern)
        for batch in batches:
            texts = [None if t is None else c.decode(t).decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return arrow_map(encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), encoded["tokens"].cast("array<int>").alias("tokens")), run, DECODED)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public 50k vocabulary, and whether they decode to it; edge cases as in ``encode_documents``."""
    return encode_documents(table(spark, sf_dir, "documents"))
