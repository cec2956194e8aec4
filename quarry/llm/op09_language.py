"""Language identification: first the family, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import ready, released
from .frames import free, table
from .textkit import data_of, slices

#: At most this many labelled documents, and bytes of them, a language are gathered to fit the machines; one document at least.
TRAIN_A_LANGUAGE, TRAIN_BYTES = 400, 4 << 20
#: A text is rejected if a smaller share of its bytes are letters, or a decision's margin is smaller.
LETTERS, MARGIN = 0.3, 0.02
DIM = 1 << 13

FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru pl cs sk uk bg hr sr sl mk be",
    "uralic": "fi et hu",
    "indic": "hi bn ur mr gu pa ne si",
    "semitic": "ar he am mt",
    "turkic": "tr az kk uz ky tk",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_CLASS = np.full(256, 32, np.int64)
_CLASS[[c for c in range(256) if chr(c).isalpha() and c < 128 or c >= 128]] = [c | 32 if c < 128 else c for c in range(256) if chr(c).isalpha() and c < 128 or c >= 128]
_LETTER = _CLASS != 32


def grams_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams, in lower case with all but letters as one sign, and each text's bounds in them."""
    c = _CLASS[raw]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    g = (c[:-2] * 7919 + c[1:-1] * 104729 + c[2:] * 15485863) * 2654435761 >> 13 & DIM - 1
    inside = np.ones(len(g), bool)
    for cut in (off[1:-1] - 1, off[1:-1] - 2):
        inside[cut[(cut >= 0) & (cut < len(g))]] = False
    inside &= (_LETTER[raw[:-2]] | _LETTER[raw[1:-1]]) | _LETTER[raw[2:]]
    total = np.concatenate([[0], np.cumsum(inside)])
    return g[inside], total[np.minimum(off, len(g))]


Row = tuple[np.ndarray, np.ndarray]


def _shares(raw: np.ndarray) -> Row:
    """The grams of one text, and the share that each has of them."""
    found, n = np.unique(grams_of(raw, np.array([0, len(raw)]))[0], return_counts=True)
    return found, n / max(1, n.sum())


def svm(rows: list[Row], y: np.ndarray, size: int, c: float = 10.0, rounds: int = 30, seed: int = 3) -> np.ndarray:
    """Weights of a linear machine with hinge loss on sparse rows, by dual coordinate descent; y is -1 or 1."""
    rng = np.random.RandomState(seed)
    a, w, norm = np.zeros(len(rows)), np.zeros(size), np.array([(v * v).sum() for _, v in rows])
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            g = y[i] * (w[at] @ v) - 1
            new = min(max(a[i] - g / max(norm[i], 1e-12), 0.0), c)
            if abs(new - a[i]) > 1e-12:
                w[at] += (new - a[i]) * y[i] * v
                most = max(most, abs(new - a[i]))
                a[i] = new
        if most < 1e-3:
            break
    return w


class Model:
    """Family machines one against the rest, and a machine for each pair of languages of a family.

    A document's decision value is the mean weight of its grams, plus a bias.
    """

    def __init__(self, rows: list[Row], languages: list[str]):
        family = [FAMILY.get(c, c) for c in languages]
        self.families = sorted(set(family))
        self.languages = {f: sorted({c for c, g in zip(languages, family) if g == f}) for f in self.families}
        self.scale = 1 / float(np.sqrt(np.mean([(v * v).sum() for _, v in rows])) or 1)
        own = [(np.append(at, DIM), np.append(v * self.scale, 1.0)) for at, v in rows]
        family, langs = np.array(family), np.array(languages)
        columns = []
        self.pairs = []
        for f in self.families if len(self.families) > 1 else []:
            columns.append(svm(own, np.where(family == f, 1, -1), DIM + 1))
        for f in self.families:
            for a, b in combinations(self.languages[f], 2):
                mine = np.flatnonzero((langs == a) | (langs == b))
                columns.append(svm([own[k] for k in mine], np.where(langs[mine] == a, 1, -1), DIM + 1))
                self.pairs.append((f, a, b))
        weights = np.stack(columns, axis=1) if columns else np.zeros((DIM + 1, 0))
        self.table, self.bias = (weights[:-1] * self.scale).astype(np.float32), weights[-1]

    def decide(self, raw: np.ndarray, off: np.ndarray) -> tuple[list, list, np.ndarray, np.ndarray]:
        """Family, language, least margin of the decisions on the way, and share of letters, of each text."""
        n = len(off) - 1
        g, bounds = grams_of(raw, off)
        size = np.diff(bounds)
        values = np.zeros((n, self.table.shape[1]))
        for k in range(self.table.shape[1]):
            total = np.concatenate([[0], np.cumsum(self.table[:, k][g], dtype=np.float64)])
            values[:, k] = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(size, 1) + self.bias[k]
        many = len(self.families) if len(self.families) > 1 else 0
        best = values[:, :many].argmax(axis=1) if many else np.zeros(n, int)
        margin = np.full(n, np.inf)
        if many:
            ranked = np.sort(values[:, :many], axis=1)
            margin = (ranked[:, -1] - ranked[:, -2]) / 2
        language = np.empty(n, object)
        for k, f in enumerate(self.families):
            mine = np.flatnonzero(best == k)
            names = self.languages[f]
            votes, least = np.zeros((len(mine), len(names))), np.full((len(mine), len(names)), np.inf)
            for p, (h, a, b) in enumerate(self.pairs):
                if h == f:
                    v = values[mine, many + p]
                    for name, sign in ((a, v), (b, -v)):
                        votes[:, names.index(name)] += (sign >= 0) + 1e-6 * np.tanh(sign)
                        least[:, names.index(name)] = np.minimum(least[:, names.index(name)], sign)
            won = votes.argmax(axis=1)
            language[mine] = np.array(names, object)[won]
            margin[mine] = np.minimum(margin[mine], least[np.arange(len(mine)), won])
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        share = (letters[off[1:]] - letters[off[:-1]]) / np.maximum(np.diff(off), 1)
        return [self.families[k] for k in best], language.tolist(), np.where(size > 0, margin, 0.0), share


def train(docs: DataFrame, most: int = TRAIN_A_LANGUAGE, most_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from up to ``most`` documents and ``most_bytes`` bytes a language, by the order of a hash of their ids; None without any."""
    size = F.octet_length("text").cast("long")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "n_bytes")
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND length(text) > 0").select("doc_id", "lang", size.alias("n_bytes"))
    first = known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    fits = first.withColumn("before", F.sum("n_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))).where((F.col("n") == 1) | (F.col("before") <= most_bytes))
    ids = fits.select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), "n_bytes").distinct()
    # At most ``most`` ids a language are broadcast.
    rows = docs.join(F.broadcast(ids), (docs["doc_id"] == ids["id"]) & (docs["lang"] == ids["language"]) & (F.octet_length(docs["text"]) == ids["n_bytes"])).select(docs["doc_id"].alias("id"), docs["text"].alias("text"), docs["lang"].alias("lang")).distinct().toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("lang", "ascending"), ("id", "ascending"), ("text", "ascending")])
    raw, off = data_of(rows.column("text"))
    return Model([_shares(raw[i:j]) for i, j in zip(off[:-1], off[1:])], rows.column("lang").to_pylist())


_OUT = "struct<family:string,language:string,margin:double,accepted:boolean>"


def decision(text: Column, model: Model | None, letters: float = LETTERS, margin: float = MARGIN) -> Column:
    """A struct of ``family, language, margin, accepted`` of a text; only texts go to Python, and only this comes back."""
    spark = SparkSession.active()
    ready(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_OUT)
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        released(__name__)
        model = shared.value
        for batch in batches:
            out = []
            for part, raw, off in slices(pa.RecordBatch.from_arrays([batch], names=["text"]), "text", 1 << 18):
                n = part.num_rows
                family, language, least, share = model.decide(raw, off) if model else ([None] * n, [None] * n, np.zeros(n), np.zeros(n))
                least = np.where(np.isinf(least), 1e9, least)
                none = (share == 0) | (np.diff(off) < 3) if model else np.ones(n, bool)
                good = ~none & (share >= letters) & (least >= margin)
                least = np.where(none, 0.0, least)
                columns = [pa.array(family, pa.string(), mask=none), pa.array(language, pa.string(), mask=none), pa.array(least), pa.array(good)]
                out.append(pa.StructArray.from_arrays(columns, names=["family", "language", "margin", "accepted"]))
            yield pa.concat_arrays(out) if out else pa.array([], pa.struct([("family", pa.string()), ("language", pa.string()), ("margin", pa.float64()), ("accepted", pa.bool_())]))

    return decide(text.cast("string"))


def identify(docs: DataFrame, model: Model | None, letters: float = LETTERS, margin: float = MARGIN, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (``doc_id`` alone by default), and ``family, language, margin, accepted``, one row per row.

    A text is accepted if enough of its bytes are letters (of a multi-byte
    character all are taken as letters) and every decision on its way has the
    margin.  Null and empty texts, texts without a trigram that holds a letter,
    and all texts where there is no model, have null family and language and
    aren't accepted.  Of equal votes the language first by name wins.  A new column
    has ``_`` behind its name where ``keep`` has one of that name; repeated rows are
    decided each, very long texts as a whole.
    """
    names = keep or ["doc_id"]
    kept = docs.select(*names)
    (found,) = free(kept, "decision")
    new = free(kept, "family", "language", "margin", "accepted")
    out = docs.select(*names, decision(docs["text"], model, letters, margin).alias(found))
    return out.select(*names, *[F.col(found)[c].alias(n) for c, n in zip(("family", "language", "margin", "accepted"), new)])


def accepted(docs: DataFrame, letters: float = LETTERS, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` that are accepted, in the same columns whatever their names; the model is fitted on ``docs`` by its ``lang``."""
    return docs.where(decision(docs["text"], train(docs), letters, margin)["accepted"])


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family, language and decision of every document, by machines fitted on the tables' ``lang``; edge cases as in ``identify``."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
