"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the character n-grams of one to NGRAM characters of the whole lower-cased text, hashed into 2**BITS columns,
weighted (1 + log tf) * idf and scaled to length one. idf comes from the document frequencies of all training documents,
summed as rows (column, count), so what reaches the driver is one row a column whatever the corpus. Weights are learned by
follow-the-regularised-leader (per-coordinate rates, elastic net: L1 makes them sparse, L2 shrinks them) on a bounded sample
of labelled documents: at most SAMPLE (one a language at least), shared out evenly over the languages, what small ones leave
over to the larger, each language's chosen by a hash of the id. One in HOLD of the sample is kept for the temperature, the divisor of the scores that makes its likelihood greatest; the
probability of the predicted language under it is the score.

Null text, or text without a letter: ``und``, score 0. Rows without doc_id are predicted, not learned from, held_out false.
Without any labelled document every prediction is ``und``. Ties go to the language that sorts first. Repeated rows each
return; lang, source and doc_id are no inputs of a prediction. Very long texts are counted whole, at about 50 bytes of memory a
character. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditloom.llm.common import chunks, id_crc, rows

NGRAM = 3
BITS = 13
#: Labelled documents that weights are learned from, at most.
SAMPLE = 4000
HOLD = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
SCAN_BYTES = 1_000_000
#: Texts counted at a time: rows of the dense (texts, DIM) matrix.
SCAN_ROWS = 128

DIM = 1 << BITS
PREDICTIONS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(texts: list[str]) -> np.ndarray:
    """(texts, DIM) n-gram counts of whole texts."""
    arrays = [np.frombuffer(t.lower().encode("utf-32-le"), np.uint32) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64)
    flat = np.concatenate(arrays).astype(np.uint64) + np.uint64(1)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    out = np.zeros(len(texts) * DIM, np.int64)
    run = np.zeros(len(flat), np.uint64)
    for n in range(1, NGRAM + 1):
        if len(flat) < n:
            break
        run = run[: len(flat) - n + 1] * np.uint64(0x100000001B3) + flat[n - 1 :]
        h = (run + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        column = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)
        inside = np.arange(len(column)) + n <= end[: len(column)]
        out += np.bincount((doc[: len(column)] * DIM + column)[inside], minlength=len(out))
    return out.reshape(len(texts), DIM)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-12)[:, None]


class Model:
    """Labels in order, idf, weights (DIM, labels), bias and temperature."""

    def __init__(self, labels: list[str], idf: np.ndarray):
        self.labels, self.idf = labels, idf
        self.w = np.zeros((DIM + 1, len(labels)))  # the last row: the bias
        self.temperature = 1.0

    def scores(self, tf: np.ndarray) -> np.ndarray:
        return weighted(tf, self.idf) @ self.w[:-1] + self.w[-1]

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """examples: columns, values (weighted), label number."""
        z, n = np.zeros_like(self.w), np.zeros_like(self.w)
        order = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for k in order.permutation(len(examples)):
                at, x, y = examples[k]
                zi, ni = z[at], n[at]
                w = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
                g = np.outer(x, softmax(x @ w) - (np.arange(len(self.labels)) == y))
                z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
                n[at] = ni + g * g
        self.w = np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def calibrate(self, examples: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """Golden-section search for the temperature's logarithm."""
        if not examples:
            return
        s, y = np.stack([x @ self.w[at] for at, x, _ in examples]), np.array([y for _, _, y in examples])

        def loss(t: float) -> float:
            v = s / np.exp(t)
            v = v - v.max(axis=1, keepdims=True)
            return float((np.log(np.exp(v).sum(axis=1)) - v[np.arange(len(y)), y]).mean())

        a, b, r = -3.0, 3.0, (5**0.5 - 1) / 2
        for _ in range(40):
            c, d = b - r * (b - a), a + r * (b - a)
            a, b = (a, d) if loss(c) <= loss(d) else (c, b)
        self.temperature = float(np.exp((a + b) / 2))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        s = self.scores(counts(texts)) / self.temperature
        best = s.argmax(axis=1)
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p = p / p.sum(axis=1, keepdims=True)
        return [(self.labels[i], float(q[i])) for i, q in zip(best.tolist(), p)]


def spans(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SCAN_BYTES and at most SCAN_ROWS."""
    for a, b in chunks(text, SCAN_BYTES):
        for c in range(a, b, SCAN_ROWS):
            yield c, min(b, c + SCAN_ROWS)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max())
    return e / e.sum()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIM, np.int64)
    n = 0
    for batch in batches:
        for a, b in spans(batch.column("text")):
            texts = [t for t in batch.column("text").slice(a, b - a).to_pylist() if has_letter(t)]
            if texts:
                total += (counts(texts) > 0).sum(axis=0)
                n += len(texts)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(np.append(at, DIM)), pa.array(np.append(total[at], n))], names=["c", "n"])  # column DIM: documents


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, *known in zip(batch.column("text"), *(batch.column(c).to_pylist() for c in ("h", "doc_id", "lang", "hold"))):
            if has_letter(text.as_py()):
                tf = counts([text.as_py()])[0]
                at = np.flatnonzero(tf)
                yield pa.record_batch([*(pa.array([x]) for x in known), pa.array([at.astype("<u2").tobytes()], pa.binary()), pa.array([tf[at].astype("<u4").tobytes()], pa.binary())], names=["h", "doc_id", "lang", "hold", "at", "tf"])


def shares(sizes: dict[str, int], sample: int) -> dict[str, int]:
    """Rows of each language: all of a small one, and evenly what is left over."""
    out, left = {}, sample
    for k, (lang, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = min(n, max(1, left // (len(sizes) - k)))
        left -= out[lang]
    return out


def sampled(labelled: DataFrame, sizes: dict[str, int], sample: int) -> DataFrame:
    """h, doc_id, text, lang of each language's rows of least hash. A limit of the hash, six deviations above the share, leaves
    few rows to number."""
    quota = shares(sizes, sample)
    of = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("lang")]
    limits = {lang: int(min(1.0, (q + 6 * q**0.5 + 20) / sizes[lang]) * (1 << 30)) for lang, q in quota.items()}
    few = labelled.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))).filter(F.col("h") < of(limits))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    return few.withColumn("place", place).filter(F.col("place") <= of(quota)).select("h", "doc_id", "text", "lang")


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """labelled: doc_id, text, lang; None if nothing can be learned."""
    labelled = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter("doc_id is not null and lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return None
    labels = sorted(sizes)
    found = {r["c"]: r["n"] for r in labelled.select("text").mapInArrow(_frequencies, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()}  # a row a column
    df = np.array([found.get(c, 0) for c in range(DIM)])
    idf = np.log((1 + found.get(DIM, 0)) / (1 + df)) + 1
    some = sampled(labelled, sizes, sample).withColumn("hold", F.col("h") % HOLD == 0)
    rows_ = some.mapInArrow(_examples, "h long, doc_id long, lang string, hold boolean, at binary, tf binary").collect()  # SAMPLE rows at most
    rows_.sort(key=lambda r: (r["h"], r["doc_id"], r["lang"], r["at"], r["tf"]))  # whatever the partitions
    model = Model(labels, idf)
    parts: dict[bool, list] = {False: [], True: []}
    for r in rows_:
        at, tf = np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["tf"], "<u4")
        x = (1 + np.log(tf)) * idf[at]
        parts[r["hold"]].append((np.append(at, DIM), np.append(x / np.sqrt((x * x).sum()), 1.0), labels.index(r["lang"])))
    if not parts[False]:
        parts[False], parts[True] = parts[True], []
    if not parts[False]:
        return None
    model.fit(parts[False])
    model.calibrate(parts[True])
    return model


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None, least: float | None) -> Iterator[pa.RecordBatch]:
    """Predictions, or with ``least`` the rows whose text has a language at that score or more."""
    for batch in batches:
        for a, b in spans(batch.column("text")):
            part = batch.slice(a, b - a)
            texts = part.column("text").to_pylist()
            out = [(UNKNOWN, 0.0)] * len(texts)
            some = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
            for i, p in zip(some, model.predict([texts[i] for i in some]) if some else ()):
                out[i] = p
            if least is None:
                yield rows(PREDICTIONS, doc_id=part.column("doc_id"), held_out=part.column("held_out"), lang_pred=[p for p, _ in out], score=[s for _, s in out])
            else:
                yield part.filter(pa.array([p != UNKNOWN and s >= least for p, s in out], pa.bool_()))


def learned(docs: DataFrame, folds: int = 4, held: int = 2) -> Model | None:
    return train(docs.filter(id_crc(F.col("doc_id")) % folds != held))


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the documents of the other folds."""
    model = learned(docs, folds, held)
    held_out = F.coalesce(id_crc(F.col("doc_id")) % folds == held, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out)
    return texts.mapInArrow(lambda it: _predict(it, model, None), "doc_id long, held_out boolean, lang_pred string, score double")


def accept(docs: DataFrame, least: float) -> DataFrame:
    """The documents (all columns) whose text has a language at a score of least or more."""
    model = learned(docs)
    return docs.mapInArrow(lambda it: _predict(it, model, least), docs.schema)
