"""Quality classifier by co-training.

Two views of a document: its text (hashed words and the shape of the text) and
its metadata (language, source, length). Each view has a logistic classifier.
In every round each classifier labels an unlabelled pool, and what it is
confident about becomes training data of the other. At the end the views are
calibrated and combined on labelled documents that neither was fitted to, and
the combination scores every document.

Fitting uses bounded samples, the documents with the smallest hashes of their
ids: ``MAX_LABELLED`` labelled ones and ``MAX_POOL`` others. Scoring covers all
documents whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, bound_batches, text_bytes

MAX_LABELLED = 16_000
MAX_POOL = 8_000
ROUNDS = 3
#: A pseudo-label is given from this probability on, either way.
CONFIDENT = 0.95
THRESHOLD = 0.5
#: Buckets of hashed features; those of one view kept by association, and how strong it must be.
BUCKETS = 1 << 18
KEPT = 3000
LEAST_Z = 4.0
#: Every CALIBRATION-th labelled document calibrates instead of training.
CALIBRATION = 4

_EDGE = b".,;:!?\"'()[]{}|*#$%&-_<>=+/\\~^@`"


def _bucket(name: bytes) -> int:
    return zlib.crc32(name) & (BUCKETS - 1)


def _shape(text: bytes, words: list[bytes], distinct: int) -> list[bytes]:
    """Binned shares that describe the text as a whole."""
    n = max(1, len(text))
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper = int(histogram[65:91].sum())
    letters = upper + int(histogram[97:123].sum() + histogram[128:].sum())
    digits, space = int(histogram[48:58].sum()), int(histogram[9:14].sum() + histogram[32])
    marks = n - letters - digits - space
    lines = text.split(b"\n")
    shares = {
        b"upper": upper / max(1, letters),
        b"digits": digits / n,
        b"marks": marks / n,
        b"distinct": distinct / max(1, len(words)),
        b"repeated lines": 1 - len(set(lines)) / len(lines),
    }
    out = [b"#%s %d" % (k, min(20, int(v * 20))) for k, v in shares.items()]
    out += [b"#%s over %d" % (k, t) for k, v in shares.items() for t in range(1, 20) if v * 20 >= t]
    out.append(b"#word length %d" % min(20, n // max(1, len(words))))
    out.append(b"#words %d" % len(words).bit_length())
    return out


def text_features(text: str | None) -> np.ndarray:
    """Distinct feature buckets of a whole text."""
    data = text_bytes(text)
    words = ascii_lower(data).split()
    distinct = set(words)
    names = {w.strip(_EDGE) for w in distinct}
    names.update(_shape(data, words, len(distinct)))
    return np.unique(np.fromiter((zlib.crc32(x) & (BUCKETS - 1) for x in names), np.int32, len(names)))


def meta_features(lang: str | None, source: str | None, n_chars: int) -> np.ndarray:
    size = int(n_chars).bit_length()
    names = [f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}"]
    return np.unique(np.array([_bucket(x.encode("utf-8", "surrogatepass")) for x in names], np.int32))


@dataclass
class Sparse:
    """Rows of distinct buckets."""

    index: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(rows: list[np.ndarray]) -> Sparse:
        lengths = np.array([len(r) for r in rows], np.int64)
        index = np.concatenate([*rows, np.empty(0, np.int32)])
        return Sparse(index, np.r_[0, np.cumsum(lengths)])

    def __len__(self) -> int:
        return len(self.starts) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def dot(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner(), weights=weight[self.index], minlength=len(self))

    def take(self, rows: np.ndarray) -> Sparse:
        return Sparse.of([self.index[self.starts[i] : self.starts[i + 1]] for i in rows])

    def only(self, kept: np.ndarray) -> Sparse:
        """Buckets renumbered to their place in ``kept`` (sorted); all others left out."""
        place = np.full(BUCKETS, -1, np.int32)
        place[kept] = np.arange(len(kept))
        new = place[self.index]
        here = new >= 0
        counts = np.bincount(self.owner()[here], minlength=len(self))
        return Sparse(new[here], np.r_[0, np.cumsum(counts)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _descend(gradient, n: int, steps: int = 150, rate: float = 0.15) -> np.ndarray:
    """Adam from zero with full gradients."""
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(1, steps + 1):
        g = gradient(w)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit_view(rows: Sparse, bad: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic classifier over all buckets, the bias last.

    Buckets enter if their presence is associated with the class: a two-sample
    z of at least ``LEAST_Z``, the ``KEPT`` strongest.
    """
    owner = rows.owner()
    n_bad, n_good = max(1, int(bad.sum())), max(1, int((~bad).sum()))
    with_bad = np.bincount(rows.index, weights=bad[owner], minlength=BUCKETS)
    with_any = np.bincount(rows.index, minlength=BUCKETS)
    share = (with_any + 1) / (len(rows) + 2)
    z = (with_bad / n_bad - (with_any - with_bad) / n_good) / np.sqrt(share * (1 - share) * (1 / n_bad + 1 / n_good))
    strong = np.flatnonzero(np.abs(z) >= LEAST_Z)
    kept = np.sort(strong[np.argsort(-np.abs(z[strong]), kind="stable")][:KEPT])
    small = rows.only(kept)
    owner, target = small.owner(), bad.astype(np.float64)

    def gradient(w: np.ndarray) -> np.ndarray:
        p = _sigmoid(np.bincount(owner, weights=w[small.index], minlength=len(small)) + w[-1])
        error = (p - target) / len(small)
        return np.r_[np.bincount(small.index, weights=error[owner], minlength=len(kept)) + ridge * w[:-1], error.sum()]

    w = _descend(gradient, len(kept) + 1)
    out = np.zeros(BUCKETS + 1)
    out[kept], out[-1] = w[:-1], w[-1]
    return out


def _fit_dense(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit on a few columns, the bias last (Platt scaling for one column)."""
    x = np.c_[x, np.ones(len(x))]
    return _descend(lambda w: x.T @ (_sigmoid(x @ w) - target) / len(x) + 1e-4 * w, x.shape[1], 400)


@dataclass
class Model:
    """``bad`` probability = sigmoid(mix . (text score, meta score, 1)); without two classes a constant."""

    text: np.ndarray
    meta: np.ndarray
    mix: np.ndarray
    constant: float | None = None

    def score(self, text: np.ndarray, meta: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        a, b = self.text[text].sum() + self.text[-1], self.meta[meta].sum() + self.meta[-1]
        return float(_sigmoid(np.array([self.mix @ (a, b, 1.0)]))[0])


def co_train(text: Sparse, meta: Sparse, bad: np.ndarray, pool_text: Sparse, pool_meta: Sparse, rounds: int) -> Model:
    """Fit both views; ``bad`` labels the rows of ``text`` and ``meta``, the pool has no labels."""
    fold = np.arange(len(bad)) % CALIBRATION == 0
    train, held = np.flatnonzero(~fold), np.flatnonzero(fold)
    if min(bad[train].sum(), (~bad[train]).sum(), bad[held].sum(), (~bad[held]).sum()) == 0:
        return Model(np.zeros(0), np.zeros(0), np.zeros(3), constant=0.0)
    views = {"text": (text, pool_text), "meta": (meta, pool_meta)}
    given = {name: (np.empty(0, np.int64), np.empty(0, bool)) for name in views}  # pool rows and their pseudo-labels
    weights = {}
    for round_ in range(rounds):
        confident = {}
        for name, (own, pool) in views.items():
            rows, labels = given[name]
            fit = Sparse.of(
                [own.index[own.starts[i] : own.starts[i + 1]] for i in train]
                + [pool.index[pool.starts[i] : pool.starts[i + 1]] for i in rows]
            )
            w = weights[name] = fit_view(fit, np.r_[bad[train], labels])
            if round_ + 1 < rounds and len(pool):
                raw = own.take(held).dot(w) + w[-1]
                platt = _fit_dense(raw[:, None], bad[held].astype(float))
                p = _sigmoid(np.c_[pool.dot(w) + w[-1], np.ones(len(pool))] @ platt)
                sure = np.flatnonzero((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
                confident[name] = sure, p[sure] >= 0.5
        if confident:
            given = {"text": confident["meta"], "meta": confident["text"]}
    scores = np.c_[
        text.take(held).dot(weights["text"]) + weights["text"][-1],
        meta.take(held).dot(weights["meta"]) + weights["meta"][-1],
    ]
    return Model(weights["text"], weights["meta"], _fit_dense(scores, bad[held].astype(float)))


def _sample_features(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Feature buckets of the documents in a bounded sample of ids, which is sent to the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text, lang, source, bad = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_id, pa.int64()),
                    pa.array([text_features(t).tobytes() for t in text], pa.binary()),
                    pa.array(
                        [meta_features(a, b, len(t or "")).tobytes() for t, a, b in zip(text, lang, source, strict=True)],
                        pa.binary(),
                    ),
                    pa.array(bad, pa.bool_()),
                ],
                names=["doc_id", "text", "meta", "bad"],
            )

    rows = docs.select(*_views(docs)).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "lang", "source", "bad")
    return rows.mapInArrow(run, "doc_id long, text binary, meta binary, bad boolean")


def _views(docs: DataFrame) -> list:
    have = set(docs.columns)
    strings = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in ("text", "lang", "source")]
    return [F.col("doc_id").cast("long").alias("doc_id"), *strings]


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL, rounds: int = ROUNDS) -> Model:
    """Fit on bounded samples of ``docs``; a labelled document is bad if its quality is 0 or it is toxic.

    Labels with a null id, or with both values null, are ignored; of several
    labels of one document the worst counts. Without documents of both classes
    the model is the constant 0: it rejects nothing.
    """
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), bad).groupBy("doc_id").agg(F.max("bad").alias("bad"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    sample = ids.join(known, "doc_id").orderBy(*order).limit(max_labelled)
    pool = ids.join(known, "doc_id", "left_anti").orderBy(*order).limit(max_pool).withColumn("bad", F.lit(None).cast("boolean"))
    rows = _sample_features(docs, sample.unionByName(pool)).toPandas()
    rows = rows.iloc[np.argsort(rows["doc_id"].to_numpy(), kind="stable")]
    views = []
    for part in (rows[rows["bad"].notna()], rows[rows["bad"].isna()]):
        views += [Sparse.of([np.frombuffer(x, np.int32) for x in part[c]]) for c in ("text", "meta")]
    target = rows.loc[rows["bad"].notna(), "bad"].to_numpy(bool)
    return co_train(views[0], views[1], target, views[2], views[3], rounds)


def score_documents(docs: DataFrame, model: Model, name: str = "p_bad") -> DataFrame:
    """``docs`` with the probability that each row is low in quality or toxic; a column of that name is replaced."""
    bound_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == name.lower()])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 x BUCKETS weights
    n = len(docs.columns)
    schema = docs.schema.add(name, "double")
    parts = docs.select("*", *(c.alias(f"__{i}") for i, c in enumerate(_views(docs)[1:])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, lang, source = (batch.column(n + i).to_pylist() for i in range(3))
            p = [
                sent.value.score(text_features(t), meta_features(a, b, len(t or "")))
                for t, a, b in zip(text, lang, source, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(p, pa.float64())], names=schema.names)

    return parts.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` with ``p_bad`` and ``rejected``: every row is scored by its own text and metadata.

    A null text is empty, null metadata a value of its own, and columns ``lang``
    and ``source`` may be missing. Repeated rows get equal scores; columns named
    ``p_bad`` or ``rejected`` are replaced. An empty table gives no rows.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "rejected"])
    return score_documents(docs, train(docs, labels, **options)).withColumn("rejected", F.col("p_bad") >= threshold)
