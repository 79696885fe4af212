"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its words' byte n-grams (``ORDERS``, with marks
at the word's ends), hashed to ``BUCKETS`` rows. Embeddings and softmax are trained by
stochastic gradient descent in numpy; half of the steps see a few subwords only, so that
short texts are learnt too. A part of the sample is kept from training: it sets the
temperature of the scores, and the score below which a prediction is rejected: at most
``REJECT_EDGE`` of the way from an even guess (1/k for k languages) to certainty, 0.35 for four
languages, and lower where more than ``REJECT_SHARE`` of the part would be rejected.

The classifier is fitted on a bounded sample: about ``ROWS_PER_LANGUAGE`` labelled rows
for each language, chosen by a hash of the id. Prediction reads every whole text. As all
is linear, a word's subwords add up to one row of class scores, computed once a block.

Nulls: a null text, or one without a letter, is ``und`` with score 0 and rejected; rows
with a null language or id are not learnt from. No labelled rows: all are ``und``. Repeated
rows each get a row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import mix, rows_in_blocks, sliced

ORDERS = (2, 3, 4)
BUCKETS = 2**16
DIMS = 16
ROWS_PER_LANGUAGE = 400
EPOCHS = 6
LEAST_STEPS = 6000
RATE = 0.5
FEW = 40
REJECT_SHARE = 0.001
REJECT_EDGE = 0.4 / 3
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_BLOCK_CHARS = 1_500_000


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all byte n-grams of ``words``; no word holds < or >."""
    joined = b"".join([b"<" + w + b">" for w in words])
    data = np.frombuffer(joined, np.uint8).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lens)
    out_word, out_bucket = [], []
    for n in ORDERS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | data[i : len(data) - n + 1 + i]
        inside = owner[: len(code)] == owner[n - 1 :]
        out_word.append(owner[: len(code)][inside])
        out_bucket.append((mix(code[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    if not out_word:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_word), np.concatenate(out_bucket)


def letters(text: str | None) -> list[bytes]:
    """Lower-case words of letters; none if the text has no letter."""
    if text is None or not any(c.isalpha() for c in text):
        return []
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "surrogatepass").split()


def _features(batches):
    """Texts to their distinct buckets and how often each occurs."""
    for batch in sliced(batches):
        found = []
        for text in batch.column(0).to_pylist():
            _, bucket = subwords(letters(text))
            found.append(np.unique(bucket, return_counts=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int64())), batch.column(1), batch.column(2)],
            names=["buckets", "counts", "label", "draw"],
        )


class Model:
    """Class scores of each bucket, biases, temperature and the score that is needed."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, heat: float, needed: float):
        self.languages, self.table, self.bias, self.heat, self.needed = languages, table, bias, heat, needed

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities from the sums of class scores over ``counts`` subwords."""
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.heat
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], seed: int = 7) -> Model:
    """Fit on (buckets, counts, class), four fifths to learn and one fifth to calibrate."""
    rng, k = np.random.default_rng(seed), len(languages)
    held = [s for i, s in enumerate(samples) if i % 5 == 4]
    learnt = [s for i, s in enumerate(samples) if i % 5 != 4]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMS)) / DIMS
    weight, bias = np.zeros((k, DIMS)), np.zeros(k)
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, len(learnt))))
    steps, step = epochs * len(learnt), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learnt)):
            buckets, counts, label = learnt[i]
            share = counts / counts.sum()
            if step % 2:
                few, times = np.unique(rng.choice(buckets, FEW, p=share), return_counts=True)
                buckets, share = few, times / FEW
            mean = share @ embedding[buckets]
            z = weight @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            rate = RATE * (1 - step / steps)
            back = weight.T @ p
            weight -= rate * np.outer(p, mean)
            bias -= 0.1 * rate * p
            embedding[buckets] -= rate * DIMS * np.outer(share, back)
            step += 1
    model = Model(languages, embedding @ weight.T, bias, 1.0, 0.0)
    if held:
        sums = np.array([c @ model.table[b] for b, c, _ in held])
        counts, truth = np.array([c.sum() for _, c, _ in held]), np.array([label for *_, label in held])

        def loss(heat: float) -> float:
            model.heat = heat
            return -np.log(np.maximum(model.scores(sums, counts)[np.arange(len(truth)), truth], 1e-12)).mean()

        model.heat = min(2.0 ** np.arange(-4, 4.5, 0.5), key=loss)
        best = np.sort(model.scores(sums, counts).max(axis=1))
        limit = (1 + REJECT_EDGE * (k - 1)) / k
        model.needed = min(limit, float(best[int(REJECT_SHARE * len(best))]))
    return model


def fit(docs: DataFrame, labels: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a sample of ``docs`` by the language in ``labels``; null languages are left out."""
    named = docs.select(F.col(text_col).alias("text"), labels.alias("label"), F.xxhash64(F.col(id_col), F.lit("sample")).alias("draw"))
    named = named.filter(F.col("label").isNotNull())
    sizes = {row[0]: row[1] for row in named.groupBy("label").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    within = F.lit(False)
    for language, n in sizes.items():
        top = min(2**63 - 1, int((2 * min(1.0, ROWS_PER_LANGUAGE / n) - 1) * 2**63))
        within = within | ((F.col("label") == language) & (F.col("draw") <= top))
    rows = named.filter(within).select("text", "label", "draw")
    rows = rows.mapInArrow(_features, "buckets array<long>, counts array<long>, label string, draw long").collect()
    rows.sort(key=lambda row: (row["draw"], row["label"], row["counts"]))  # any order of the tasks trains alike
    number = {language: i for i, language in enumerate(languages)}
    return train([(np.array(b), np.array(c), number[label]) for b, c, label, _ in rows if len(b)], languages)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text its language, score, and whether the prediction is rejected."""
    k = len(model.languages)
    numbers, pieces = defaultdict(count().__next__), []
    for text in texts:
        words = letters(text)
        pieces.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    owner, bucket = subwords(list(numbers))
    # the last column counts subwords
    per_word = np.column_stack([
        np.bincount(owner, model.table[bucket, j] if j < k else None, len(numbers)) for j in range(k + 1)
    ])
    lens = np.array([len(p) for p in pieces], np.int64)
    doc, seq = np.repeat(np.arange(len(texts)), lens), np.concatenate([*pieces, np.zeros(0, np.int64)])
    sums = np.column_stack([np.bincount(doc, per_word[seq, j], len(texts)) for j in range(k + 1)])
    if not k:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    p = model.scores(sums[:, :k], sums[:, k])
    best = p.argmax(axis=1)
    score = np.where(lens > 0, p[np.arange(len(texts)), best], 0.0)
    return [model.languages[b] if n else UNKNOWN for b, n in zip(best, lens)], score, (lens == 0) | (score < model.needed)


def _identify(shared):
    def identify(batches):
        for rows in rows_in_blocks(batches, lambda r: len(r[1] or ""), _BLOCK_CHARS):
            language, score, rejected = predict(shared.value, [r[1] for r in rows])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([r[0] for r in rows], pa.int64()), "held_out": pa.array([r[2] for r in rows], pa.bool_()),
                "lang_pred": language, "score": score, "rejected": rejected,
            })

    return identify


def _learnt(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[Column, object]:
    """Which rows are held out, and the model of the others for the tasks."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
    learn = F.when(~held & F.col(id_col).isNotNull(), F.col(lang_col))
    return held, docs.sparkSession.sparkContext.broadcast(fit(docs, learn, id_col, text_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each document: language, score, and whether the prediction is rejected.

    Learns only from labelled documents whose crc32 of the id leaves 0 or 2 on division by 3.
    """
    held, shared = _learnt(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col), held)
    return rows.mapInArrow(_identify(shared), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose language is rejected."""
    _, shared = _learnt(docs, id_col, text_col, lang_col)
    at = docs.columns.index(text_col)

    def accept(batches):
        for batch in sliced(batches):
            yield batch.filter(pa.array(~predict(shared.value, batch.column(at).to_pylist())[2]))

    return docs.mapInArrow(accept, docs.schema)
