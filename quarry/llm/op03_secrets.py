"""Secret scans: a random forest tells secrets from other strings that look like them.

Candidates are runs of the characters that keys are made of, and whatever is
assigned to a credential's name.  The forest sees their length, the transitions of
their characters, how far dictionary words cover them, the path of the document and
the words before and after them.  It is trained from labelled findings; where a
caller has none, from findings that are generated here with a fixed seed.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map
from .frames import table
from .op05_bpe import load_ranks
from .textkit import slices
from .trees import Forest, random_forest

#: Characters at least of a candidate that nothing is said to be assigned to, and how many labelled findings are used at most.
LEAST, TRAIN_FINDINGS = 12, 20_000
#: Letters at least of a dictionary word, and the public vocabulary whose words are the dictionary by default.
WORD, VOCABULARY = 4, "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Bytes before and after a candidate in which neighbouring words are looked for.
BESIDE = 40

_KEYISH = np.zeros(256, bool)
_KEYISH[[ord(c) for c in string.ascii_letters + string.digits + "_-+/."]] = True
_DIGIT = np.array([48 <= c <= 57 for c in range(256)])
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_KIND = np.full(256, 3)
_KIND[[*range(97, 123)]], _KIND[[*range(65, 91)]], _KIND[[*range(48, 58)]] = 0, 1, 2

_NAMES = rb"passw(?:or)?d|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|signing[_-]?key|credential|client[_-]?secret|auth|bearer"
_GOOD = re.compile(rb"(?i)(" + _NAMES + rb"|aws|signing)")
#: What stands before = or : if a credential is assigned, and what stands after it.
_NAME = re.compile(rb"(?i)(?:" + _NAMES + rb")[\w-]{0,20}[\"']?[ \t]{0,3}\Z")
_VALUE = re.compile(rb"[=>]?[ \t]{0,3}(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'`,;<>(){}\[\]]+))")
_BAD = re.compile(rb"(?i)(commit|sha\d*|md5|checksum|digest|hash|uuid|guid|etag|revision|order|invoice|isbn|card|phone|iban|version|build|example|sample|dummy|placeholder|test|https?:|www|mailto|image|file|href|src)")
_KNOWN = re.compile(rb"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|sk[-_]|pk[-_]|xox[abpr]-|AIza|eyJ|glpat-|SG\.|npm_|dop_v1_)")
_UUID = re.compile(rb"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
_HEX = re.compile(rb"^[0-9a-fA-F]+$")
_SAFE_PATH = re.compile(r"(?i)(^|[/_.-])(tests?|fixtures?|examples?|docs?|samples?|mocks?)([/_.-]|$)")
_CODE_PATH = re.compile(r"(?i)(\.(env|ya?ml|json|ini|cfg|conf|toml|properties|py|js|ts|sh|tf)$|(^|/)(config|secrets?|deploy)(/|$))")
FEATURES = ("length", "digits", "upper", "lower", "signs", "transitions", "entropy", "pairs", "hex", "uuid", "known", "covered", "dots", "slashes", "good", "good_near", "bad", "bad_near", "good_after", "bad_after", "named", "assigned", "quoted", "at", "path_depth", "safe_path", "code_path")


def dictionary(vocabulary: str = VOCABULARY) -> tuple[str, ...]:
    """The lower-case words of a public vocabulary, as many as it has."""
    found = (b.strip() for b in load_ranks(vocabulary))
    return tuple(sorted({b.decode() for b in found if len(b) >= WORD and b.isalpha() and b.isascii() and b == b.lower()}))


class Words:
    """How far dictionary words cover a string."""

    def __init__(self, words: Iterable[str]):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        for w in words:
            self.find.add_word(w, len(w))
        self.find.make_automaton()

    def covered(self, found: bytes) -> int:
        """Bytes that stand in a word."""
        total = reach = 0
        spans = sorted((end - n + 1, end + 1) for end, n in self.find.iter(found.lower().decode("latin-1")))
        for i, j in spans:
            total += max(0, j - max(i, reach))
            reach = max(reach, j)
        return total


@cache
def words_from(words: tuple[str, ...] | None = None) -> Words:
    return Words(dictionary() if words is None else words)


def features(before: bytes, found: bytes, after: bytes, path: str, words: Words | None = None) -> list[float]:
    """One row of FEATURES of a candidate between its neighbouring bytes."""
    words = words or words_from()
    n = len(found)
    kinds = _KIND[np.frombuffer(found, np.uint8)]
    share = np.bincount(kinds, minlength=4) / n
    counts = np.bincount(np.frombuffer(found, np.uint8))
    p = counts[counts > 0] / n
    good = [n.end() for n in _GOOD.finditer(before)]
    bad = [n.end() for n in _BAD.finditer(before)]
    tail = before.rstrip(b" \t")
    return [
        math.log(n), share[2], share[0 + 1], share[0], share[3], float((kinds[1:] != kinds[:-1]).mean()) if n > 1 else 0.0,
        float(-(p * np.log2(p)).sum()), len({found[i : i + 2] for i in range(n - 1)}) / max(1, n - 1), float(bool(_HEX.match(found))), float(bool(_UUID.match(found))), float(bool(_KNOWN.match(found))),
        words.covered(found) / n, found.count(b".") / n, found.count(b"/") / n,
        float(len(good)), float(len(before) - good[-1]) if good else 99.0, float(len(bad)) + len(_BAD.findall(found)), float(len(before) - bad[-1]) if bad else 99.0,
        float(len(_GOOD.findall(after))), float(len(_BAD.findall(after))), float(bool(_NAME.search(tail.rstrip(b"\"'`").rstrip(b" \t").rstrip(b"=:>").rstrip(b" \t")))),
        float(tail.rstrip(b"\"'`").rstrip(b" \t")[-1:] in (b"=", b":")), float(tail[-1:] in (b'"', b"'", b"`")), float(b"@" in (before[-1:], after[:1])),
        float(path.count("/")), float(bool(_SAFE_PATH.search(path))), float(bool(_CODE_PATH.search(path))),
    ]


def candidates(raw: np.ndarray, off: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of what may be a secret.

    That is every run of ``least`` key characters or more that has a digit, or two
    capitals after its first character; and, of any length and any signs, what follows
    a credential's name and = or :, up to its quote, or to white space, a comma, a
    semicolon or a bracket where it isn't quoted.  The latter takes the place of runs in it.
    """
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _KEYISH[raw]
    begins, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cut = off[(off > 0) & (off < len(raw))]
    cut = cut[inside[cut] & inside[cut + 1]]
    begins[cut] = stops[cut] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    long = end - start >= least
    start, end = start[long], end[long]
    dot = (end > start) & (raw[np.maximum(end - 1, 0)] == 46)  # a full stop ends the sentence, not the key
    end = end - dot
    digits, upper = (np.concatenate([[0], np.cumsum(x[raw])]) for x in (_DIGIT, _UPPER))
    odd = (digits[end] > digits[start]) | (upper[end] - upper[np.minimum(start + 1, end)] >= 2)
    odd &= end - start >= least
    start, end = start[odd], end[odd]
    named = _assigned(raw, off)
    if len(named):
        at = np.searchsorted(named[:, 0], end, "left") - 1  # the last one that begins before the run ends
        free = (at < 0) | (named[np.maximum(at, 0), 1] <= start)
        start, end = np.concatenate([start[free], named[:, 0]]), np.concatenate([end[free], named[:, 1]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    return np.searchsorted(off, start, "right") - 1, start, end


def _assigned(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts and ends of values assigned to a credential's name, none within another."""
    data, found, reach = raw.tobytes(), [], 0
    at = np.flatnonzero((raw == 61) | (raw == 58))
    for p, d in zip(at.tolist(), (np.searchsorted(off, at, "right") - 1).tolist()):
        if p < reach or not _NAME.search(data[max(int(off[d]), p - BESIDE) : p]):
            continue
        m = _VALUE.match(data, p + 1, int(off[d + 1]))
        if m:
            i, j = m.span(m.lastindex)
            j -= m.lastindex == 3 and j - i > 1 and data[j - 1] == 46
            found.append((i, j))
            reach = j
    return np.array(found, np.int64).reshape(-1, 2)


def generated_findings(n: int = 8000, seed: int = 11) -> list[tuple[bytes, bytes, bytes, str, int]]:
    """Labelled findings: bytes before, the candidate, bytes after, path, and whether it is a secret."""
    r = random.Random(seed)
    hexa, b62 = "0123456789abcdef", string.ascii_letters + string.digits
    some = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    known = [w for w in dictionary() if len(w) < 11]
    word = lambda: r.choice(known) if r.random() < 0.7 else some("etaoinshrdlucmfwyp", r.randint(2, 9))
    prose = lambda: " ".join(word() for _ in range(r.randint(0, 6)))
    path = lambda: r.choice(["", word(), word() + "/" + word(), "src/" + word() + ".py", "config/" + word() + ".yaml", "deploy/.env", "tests/test_" + word() + ".py", "docs/" + word() + ".md", "lib/" + word() + ".js", "https://" + word() + ".org/" + word()])
    key = lambda: r.choice(["", "", word() + "_", "DB_", "my_"]) + r.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "client_secret", "auth_token", "private_key", "credential", "PASSWORD", "API_KEY", "SECRET"])
    sign = lambda: r.choice([" = ", "=", ": ", '": "', ' = "', "='", ":", " := "])
    ends = lambda: r.choice(["", '"', "'", " ", "\n", ". ", ", "]) + prose()
    leet = lambda w: "".join({"o": "0", "e": "3", "a": "4", "i": "1", "s": "5"}.get(c, c) if r.random() < 0.5 else c for c in w)
    out = []
    for k in range(n):
        if k % 2:
            kind = r.randint(0, 9)
            value = [
                lambda: some(hexa, r.choice([18, 20, 24, 32, 40, 64])), lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16),
                lambda: r.choice(["ghp_", "gho_", "glpat-", "sk_live_", "npm_"]) + some(b62, r.choice([20, 24, 36])), lambda: some(b62 + "+/", r.choice([24, 32, 40, 44, 64])),
                lambda: "eyJ" + some(b62, 30) + "." + some(b62, 40), lambda: some(b62, r.randint(14, 24)),
                lambda: r.choice([leet(word()).capitalize(), word()]) + some("!@#$%&*?", r.randint(0, 2)) + some(string.digits, r.randint(1, 4)), lambda: some(b62 + "!@#$%&*?-_", r.randint(8, 20)),
                lambda: "".join(r.choice(known) for _ in range(r.randint(3, 5))), lambda: some(string.ascii_lowercase, r.randint(12, 32)),
            ][kind]()
            bare = bool(_KNOWN.match(value.encode())) and r.random() < 0.6
            lead = prose() + " " + ("" if bare else key() + sign())
            out.append((lead.encode()[-BESIDE:], value.encode(), ends().encode()[:BESIDE], path(), 1))
        else:
            before, value, after = r.choice([
                lambda: (prose() + " ", some(string.digits, r.choice([12, 13, 14, 16, 18])), " " + prose()),
                lambda: (prose() + " ", word() + "." + some(string.digits, r.randint(1, 4)) + word(), "@" + word() + r.choice([".com", ".org", ".net"])),
                lambda: (word() + "@", word() + some(string.digits, r.randint(1, 3)) + "." + word() + r.choice([".com", ".org", ".net"]), " " + prose()),
                lambda: (prose() + r.choice([" commit ", " sha1: ", " md5 = ", " checksum: ", " etag=", " revision "]), some(hexa, r.choice([32, 40, 64])), " " + prose()),
                lambda: (prose() + r.choice([" ", " id ", " uuid: "]), "-".join(some(hexa, q) for q in (8, 4, 4, 4, 12)), " "),
                lambda: (prose() + " https://", "www." + word() + ".com/" + word() + "/" + some(string.digits, 4), " "),
                lambda: (prose() + " ", "".join(w.capitalize() for w in (word(), word(), word())), " " + prose()),
                lambda: (prose() + " ", "-".join([word(), word(), some(string.digits, 4)]), " "),
                lambda: (prose() + " ", word().upper() + "-" + word().upper() + "_" + word().upper(), " " + prose()),
                lambda: (key() + sign(), r.choice(["your_", "example_", "test-", "dummy_", "my-", "<", "insert_", "change_"]) + r.choice(["password", "token", "key", "secret", "me"]) + r.choice(["", "_here", ">", "_" + some(string.digits, r.randint(1, 3))]), ends()),
                lambda: (key() + sign(), r.choice(["null", "None", "true", "false", "required", "string", "undefined", "xxxxxxxx", "********", "...", "0", "1", "changeme", "placeholder", "REDACTED", "<redacted>", "n/a"]), ends()),
                lambda: (key() + sign(), r.choice(["${", "$", "%(", "{{ ", "os.environ", "config.", "request.", "self.", "getenv", "process.env."]) + word().upper() + r.choice(["}", "", ")s", " }}"]), ends()),
                lambda: (key() + ": ", word(), " " + prose()),
                lambda: (prose() + " ", "+" + some(string.digits, 3) + "-" + some(string.digits, 3) + "-" + some(string.digits, 4), " " + prose()),
                lambda: (prose() + " ", "/".join([word(), word(), word() + some(string.digits, 2)]) + ".png", " "),
                lambda: (prose() + " ", word() + word() + some(string.digits, r.randint(1, 2)), " " + prose()),
            ])()
            out.append((before.encode()[-BESIDE:], value.encode(), after.encode()[:BESIDE], path(), 0))
    return out


def train(findings: Iterable[tuple[bytes, bytes, bytes, str, int]] | None = None, most: int = TRAIN_FINDINGS, seed: int = 11, words: Words | None = None) -> Forest:
    """A forest from labelled findings, a seeded sample of ``most`` of them where there are more; from generated ones where there are none."""
    rows = list(findings) if findings is not None else generated_findings()
    rows = random.Random(seed).sample(rows, most) if len(rows) > most else rows
    return random_forest(np.array([features(*row[:4], words) for row in rows]), np.array([float(row[4]) for row in rows]))


def labelled(findings: DataFrame, most: int = TRAIN_FINDINGS) -> list[tuple[bytes, bytes, bytes, str, int]]:
    """Up to ``most`` rows of ``before, found, after, path, secret``, in the order of a hash of them; rows without a finding or a label are left out."""
    rows = findings.where("length(found) > 0 AND secret IS NOT NULL").orderBy(F.xxhash64("before", "found", "after", "path"), "found").limit(most)
    as_bytes = lambda x: bytes(x) if isinstance(x, bytes | bytearray) else (x or "").encode()
    return [(as_bytes(r["before"])[-BESIDE:], as_bytes(r["found"]), as_bytes(r["after"])[:BESIDE], r["path"] or "", int(r["secret"])) for r in rows.toLocalIterator()]


_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("probability", T.DoubleType()), T.StructField("secret", T.BooleanType())])
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("secret", pa.bool_())])


def scan(docs: DataFrame, forest: Forest | None = None, path_col: str = "source", limit: float = 0.5, words: tuple[str, ...] | None = None) -> DataFrame:
    """``(doc_id, start, end, probability, secret)``: every candidate of every text, at byte offsets, with the forest's vote.

    What a candidate is ``candidates`` says; other strings have no row.  Null and empty
    texts have no candidates; a null path is an empty one; null ids stay null, repeated
    rows are scanned each, very long texts as a whole, and other columns aren't read.
    ``words`` is the dictionary that the forest was trained with, by default that of
    ``dictionary``; it is of a fixed size and is broadcast with the forest.
    """
    words = dictionary() if words is None else words
    shared = docs.sparkSession.sparkContext.broadcast((forest or train(words=Words(words)), words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, words = shared.value
        words = words_from(words)
        for batch in batches:
            for part, raw, off in slices(batch, "text", 1 << 19):
                doc, start, end = candidates(raw, off)
                if not len(doc):
                    continue
                data, paths, ids = raw.tobytes(), part.column(2).to_pylist(), part.column(0)
                x = [features(data[max(off[d], i - BESIDE) : i], data[i:j], data[j : min(off[d + 1], j + BESIDE)], paths[d] or "", words) for d, i, j in zip(doc.tolist(), start.tolist(), end.tolist())]
                p = np.round(forest.sums(np.array(x)), 6)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(start - off[doc]), pa.array(end - off[doc]), pa.array(p), pa.array(p >= limit)], schema=_OUT_ARROW)

    return arrow_map(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs[path_col].cast("string").alias("path")), run, _OUT)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, with the vote of a forest trained on generated findings; edge cases as in ``scan``."""
    return scan(table(spark, sf_dir, "documents"))
