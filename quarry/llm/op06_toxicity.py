"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_map
from .frames import table
from .textkit import _BYTE, _LOWER, _ROOT, _ROOT_INV, Words, _powers, data_of, mix, slices, words_of
from .trees import Forest, boosted, isotonic

#: At most this many labelled documents, and bytes of them, a class are gathered to fit the model.
TRAIN_A_CLASS, TRAIN_BYTES = 2000, 32 << 20
#: Words within which second person and insult count as near.
NEAR = 5
#: Bytes of the beginnings of words that are learned beside whole words.
STEMS = (4, 5, 6, 7)

STRONG = """
idiot idiots moron morons scum loser losers trash worthless disgusting pathetic stupid clown imbecile cretin dumbass jackass
bastard asshole bitch degenerate vermin filth parasite lowlife pig swine freak creep coward liar garbage subhuman
idiota imbécil estúpido estúpida basura asqueroso payaso perdedor escoria idiote imbécile stupide ordure connard salaud
dégoûtant déchet clown idiotisch dumm dummkopf trottel abschaum arschloch ekelhaft versager müll
""".split()
WEAK = """
hate kill die ugly dumb shut damn hell crap sucks suck awful horrible fool silly weak sick nasty dirty lame useless hopeless
odio muere feo tonto cállate haine meurs laid sot hasse stirb hässlich blöd
""".split()
YOU = "you your yours yourself u ur youre tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie tú ti usted ustedes vosotros vuestro".split()
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!", b"oieastasi"):
    _LEET[_a] = _b

FEATURES = ("strong", "weak", "learned", "hits", "you", "near", "capitals", "shouts", "exclaims", "asks", "punctuation", "runs", "mixed", "hidden", "words", "foreign")


def hashes(words: list[str]) -> np.ndarray:
    raw, off = data_of(pa.array(words, pa.string()))
    return np.unique(words_of(raw, off).hash)


_TABLE = np.uint64((1 << 20) - 1)


def keys_of(raw: np.ndarray, off: np.ndarray, w: Words) -> np.ndarray:
    """A row of the words' hashes, and one for each length of stem; shorter words have 0 there."""
    start = w.start + np.repeat(off[:-1], np.diff(w.bounds))
    size = w.end - w.start
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * _powers(_ROOT, len(raw)), out=total[1:])
    back = _powers(_ROOT_INV, len(raw) + 1)
    out = np.zeros((1 + len(STEMS), len(size)), np.uint64)
    out[0] = w.hash
    for row, k in enumerate(STEMS, 1):
        long = np.flatnonzero(size > k)
        at = start[long]
        out[row, long] = mix((total[at + k] - total[at]) * back[at] + np.uint64(k))
    return out


class Lexicon:
    """Sets of hashed words with a quick first test."""

    def __init__(self, *sets: np.ndarray):
        self.known = np.unique(np.concatenate(sets))
        self.member = np.stack([np.isin(self.known, s) for s in sets])
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.known & _TABLE).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are known, whole or by a stem, and as what; ``keys`` has a row for each kind."""
        places, which = zip(*(self._find(k) for k in keys))
        place, which = np.concatenate(places), np.concatenate(which)
        order = np.argsort(place, kind="stable")
        return place[order], which[order]

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words, and which they are."""
        maybe = np.flatnonzero(self.table[(h & _TABLE).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        sure = self.known[at] == h[maybe]
        return maybe[sure], at[sure]


def lexicon(learned: np.ndarray) -> Lexicon:
    return Lexicon(hashes(STRONG), hashes(WEAK), learned, hashes(YOU))


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def features(raw: np.ndarray, off: np.ndarray, lex: Lexicon) -> np.ndarray:
    """One row of FEATURES a text; a text without words has zeros for all rates."""
    n = len(off) - 1
    w = words_of(raw, off)
    count = np.diff(w.bounds)
    words, size = np.maximum(count, 1), np.maximum(np.diff(off), 1)
    place, which = lex.find(keys_of(raw, off, w))
    fresh = np.append(True, place[1:] != place[:-1]) if len(place) else np.zeros(0, bool)
    group = np.flatnonzero(fresh)
    member = np.logical_or.reduceat(lex.member[:, which], group, axis=1) if len(group) else lex.member[:, which]
    place = place[group]
    strong, weak, learned, you = member
    owner = np.searchsorted(w.bounds, place, "right") - 1
    per = lambda mask: np.bincount(owner[mask], minlength=n)
    insult = strong | learned
    mine, theirs = place[you], place[insult]
    near = np.zeros(len(theirs), bool)
    if len(mine) and len(theirs):
        right = np.searchsorted(mine, theirs)
        for k in (np.maximum(right - 1, 0), np.minimum(right, len(mine) - 1)):
            near |= (np.abs(mine[k] - theirs) <= NEAR) & (owner[you][k] == owner[insult])
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    letter = upper | lower
    high = raw >= 128
    bang, ask = raw == 33, raw == 63
    punct = (raw > 32) & (raw < 128) & ~letter & ~((raw >= 48) & (raw <= 57))
    odd = ((raw >= 48) & (raw <= 57)) | (raw == 64) | (raw == 36) | (raw == 42) | bang
    mixed, shout, run = np.zeros(len(raw), bool), np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    if len(raw) > 2:
        mixed[1:-1] = odd[1:-1] & (letter[:-2] & letter[2:])
        shout[2:] = upper[2:] & upper[1:-1] & upper[:-2]
        run[1:] = bang[1:] & bang[:-1]
    letters = np.maximum(_per_text(letter, off), 1)
    disguised = _per_text(mixed, off)
    hidden = np.zeros(n)
    if disguised.any():  # read disguised words of these texts once more, with digits and signs as letters
        for d in np.flatnonzero(disguised).tolist():
            plain = _LEET[raw[off[d] : off[d + 1]]]
            _, kind = lex._find(words_of(plain, np.array([0, len(plain)])).hash)
            hits = int((lex.member[0][kind] | lex.member[2][kind]).sum())
            hidden[d] = max(0, hits - int(insult[owner == d].sum()))
    hits = per(insult)
    return np.stack([
        per(strong) / words, per(weak) / words, per(learned) / words, hits + hidden, per(you) / words,
        np.bincount(owner[insult][near], minlength=n) / words, _per_text(upper, off) / letters, _per_text(shout, off) / letters,
        _per_text(bang, off) / size, _per_text(ask, off) / size, _per_text(punct, off) / size, _per_text(run, off) / size,
        disguised / words, hidden / words, np.log1p(count), _per_text(high, off) / size,
    ], axis=1).astype(np.float64)


def _parts(texts: pa.Array, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of consecutive texts, so that working arrays stay small."""
    for _, raw, off in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", most):
        yield raw, off


def _features(texts: pa.Array, lex: Lexicon) -> np.ndarray:
    return np.concatenate([features(raw, off, lex) for raw, off in _parts(texts)])


def learn_words(texts: pa.Array, y: np.ndarray, most: int = 2000) -> np.ndarray:
    """Words and stems that toxic training texts have far more often than others, by a z score of document counts."""
    keys, docs, first = [], [], 0
    for raw, off in _parts(texts):
        w = words_of(raw, off)
        keys.append(keys_of(raw, off, w))
        docs.append((w.doc + first).astype(np.int32))
        first += len(off) - 1
    doc = np.concatenate(docs)
    na, nb = max(1, int((y > 0).sum())), max(1, int((y == 0).sum()))
    found, scores = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for kind in range(1 + len(STEMS)):
        own = np.concatenate([k[kind] for k in keys])
        order = np.lexsort((doc, own))
        k, d = own[order], doc[order]
        fresh = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]))[: len(k)] & (k != 0)
        k, d = k[fresh], d[fresh]
        known, at = np.unique(k, return_inverse=True)
        a, b = (np.bincount(at, (y[d] > 0) == side, len(known)) for side in (True, False))
        p = (a + b + 0.5) / (na + nb + 1)
        z = (a / na - b / nb) / np.sqrt(p * (1 - p) * (1 / na + 1 / nb))
        good = (z > 5) & (a / na > 20 * b / nb) & (a >= 4)
        found.append(known[good])
        scores.append(z[good])
    z = np.concatenate(scores)
    return np.concatenate(found)[np.argsort(-z, kind="stable")][:most]


class Model:
    def __init__(self, lex: Lexicon, forest: Forest, knots: np.ndarray, values: np.ndarray):
        self.lex, self.forest, self.knots, self.values = lex, forest, knots, values

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        return self.forest.sums(features(raw, off, self.lex))

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.knots, self.values)


def fit(texts: pa.Array, y: np.ndarray, weight: np.ndarray) -> Model:
    """Words are learned and trees boosted on three quarters of the rows; the rest calibrates."""
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held[:] = False
    rows = texts.filter(pa.array(~held))
    lex = lexicon(learn_words(rows, y[~held]))
    forest = boosted(_features(rows, lex), y[~held], weight[~held])
    use = held if held.any() else ~held
    return Model(lex, forest, *isotonic(forest.sums(_features(texts.filter(pa.array(use)), lex)), y[use], weight[use]))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_A_CLASS, most_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from up to ``most`` labelled documents and ``most_bytes`` bytes a class (one document at least), taken in the order of a hash of their ids; None without labels."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return None
    chosen = None
    for y in sorted(totals):
        own = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = own if chosen is None else chosen.unionByName(own)
    chosen = chosen.select(F.col("doc_id").alias("id"), F.col("toxic").alias("y"))
    # At most two times ``most`` ids are broadcast; of their texts no more come back than the bytes allow.
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).where(docs["text"].isNotNull()).select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), chosen["y"].alias("toxic"))
    within = F.sum(F.octet_length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"within": within, "n": F.row_number().over(order)}).where((F.col("n") == 1) | (F.col("within") <= most_bytes)).drop("within", "n").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    y = rows.column("toxic").to_numpy().astype(float)
    if not len(y):
        return None
    share = np.array([totals[k] / max(1, (y == k).sum()) for k in (0, 1)] if len(totals) > 1 else [1.0, 1.0])
    weight = share[y.astype(int)]
    return fit(rows.column("text").combine_chunks(), y, weight / weight.mean())


_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("probability", T.DoubleType()), T.StructField("toxic", T.BooleanType())])
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("probability", pa.float64()), ("toxic", pa.bool_())])


def toxicity(docs: DataFrame, labels: DataFrame, limit: float = 0.5, most: int = TRAIN_A_CLASS) -> DataFrame:
    """``(doc_id, score, probability, toxic)``, one row per row of ``docs``.

    ``score`` is the trees' log odds, ``probability`` is calibrated, ``toxic``
    whether it reaches ``limit``.  A null text counts as an empty one, which has no
    insult; null ids stay null; repeated rows are scored each, and extra columns
    aren't read.  A document with several labels is toxic if one says so.  Without
    any labelled text all three columns are null.
    """
    model = train(docs, labels, most)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, raw, off in slices(batch, "text", 1 << 19):
                if model is None:
                    none = pa.nulls(part.num_rows, pa.float64())
                    yield pa.RecordBatch.from_arrays([part.column(0), none, none, pa.nulls(part.num_rows, pa.bool_())], schema=_OUT_ARROW)
                    continue
                score = model.scores(raw, off)
                p = model.probabilities(score)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(p), pa.array(p >= limit)], schema=_OUT_ARROW)

    return arrow_map(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), run, _OUT)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of toxicity of every document, by a model of the tables' labels; edge cases as in ``toxicity``."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
