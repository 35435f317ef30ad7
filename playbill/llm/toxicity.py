"""Toxicity by multiple-instance learning.

Only documents have labels, but toxicity lies in sentences. Each sentence has a logistic score over
its words; a document is toxic if any sentence is (noisy-or). The sentence weights are trained from
the document labels through the noisy-or, so they also say which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import join_bounded, word_hashes
from playbill.session import cut_lineage

# letters in lower case and bytes above ASCII stay; the ends of sentences are line feeds, the rest blanks
FOLD = bytes(10 if b in b".!?\n" else b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def sentences(text: str | None) -> list[list[bytes]]:
    """The words of each sentence of the whole text; sentences without words count, so that places
    agree with sentence_texts."""
    return [part.split() for part in (text or "").encode().translate(FOLD).split(b"\n")]


def sentence_texts(text: str) -> list[str]:
    data, at, out = text.encode(), 0, []
    for part in data.translate(FOLD).split(b"\n"):
        out.append(data[at : at + len(part)].decode().strip())
        at += len(part) + 1
    return out


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def evidence(toxic: np.ndarray, docs: np.ndarray, all_toxic: float, n: int) -> np.ndarray:
    """The G statistic of each word: how far its share of toxic documents is from that of all."""
    total = np.zeros(len(docs))
    for seen, expected in (
        (toxic, docs * all_toxic / n),
        (docs - toxic, docs * (n - all_toxic) / n),
        (all_toxic - toxic, (n - docs) * all_toxic / n),
        (n - all_toxic - docs + toxic, (n - docs) * (n - all_toxic) / n),
    ):
        some = (seen > 0) & (expected > 0)
        total[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    return total


@dataclass
class Model:
    """Sorted word hashes, their weights and the bias of a sentence."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_scores(self, text: str | None) -> np.ndarray:
        """The probability of each sentence with words to be toxic; 0 for one without."""
        parts = sentences(text)
        sizes = np.array([len(p) for p in parts], np.int64)
        if not sizes.sum():
            return np.zeros(len(parts))
        owner = np.repeat(np.arange(len(parts)), sizes)
        hashes = word_hashes([w for p in parts for w in p])
        total = np.full(len(parts), self.bias)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == hashes)
            # a word counts once in a sentence
            pairs = np.unique(np.stack([owner[hit], at[hit]]), axis=1) if len(hit) else np.empty((2, 0), np.int64)
            total += np.bincount(pairs[0], weights=self.weights[pairs[1]], minlength=len(parts))
        scores = sigmoid(total)
        scores[sizes == 0] = 0.0
        return scores

    def score(self, text: str | None) -> tuple[float, np.ndarray]:
        """Noisy-or of the sentences, and their scores. A text without words has the score of one
        sentence without known words."""
        each = self.sentence_scores(text)
        if not each.any():
            return float(sigmoid(np.array(self.bias))), each
        return float(-np.expm1(np.log1p(-np.minimum(each, 1 - 1e-12)).sum())), each


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
        max_docs: int = 5000, min_docs: int = 4, least_evidence: float = 12.0, rounds: int = 200, spread: float = 5.0, start_bias: float = -5.0) -> Model:
    """Fit on a bounded sample of at most `max_docs` labelled documents (smallest hashed ids), whole texts.

    The weights are the most likely ones under a normal prior with deviation `spread`, over the words
    that are in `min_docs` sample documents or more and whose share of toxic ones differs from that of
    all by `least_evidence` (G statistic). NULL labels and ids teach nothing; an id with several
    labels counts as toxic if any says so. Without any label the model is the bias alone.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(F.max(F.col(label_column).cast("int")).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    known = cut_lineage(known)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, sizes = [], []
            for text in batch.column(2).to_pylist():
                parts = [p for p in sentences(text) if p]
                each = [np.unique(word_hashes(p)) for p in parts]
                data.append(np.concatenate(each).tobytes() if each else b"")
                sizes.append(np.array(list(map(len, each)), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary()), pa.array(sizes, pa.binary())], ["doc_id", "y", "data", "sizes"])

    texts = join_bounded(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), known, ["doc_id"], "inner", 24)
    texts = cut_lineage(texts.select("doc_id", "y", "text").mapInArrow(counted, f"doc_id {docs.schema[id_column].dataType.simpleString()}, y int, data binary, sizes binary"))
    y, words, sizes, counts = [], [], [], []
    for _, label, data, size in texts.orderBy("doc_id", F.xxhash64("data"), "y").toLocalIterator():
        if size:
            y.append(label)
            words.append(np.frombuffer(data, np.uint64))
            sizes.append(np.frombuffer(size, np.int32))
            counts.append(len(sizes[-1]))
    empty = Model(np.empty(0, np.uint64), np.empty(0), start_bias)
    if not y:
        return empty
    y = np.array(y, np.float64)
    doc_of_sentence = np.repeat(np.arange(len(y)), counts)
    sentence_of = np.repeat(np.arange(len(doc_of_sentence)), np.concatenate(sizes)).astype(np.int32)
    names, at = np.unique(np.concatenate(words), return_inverse=True)
    at = at.astype(np.int32)
    pairs = np.unique(doc_of_sentence[sentence_of].astype(np.int64) * len(names) + at)
    in_docs = np.bincount(pairs % len(names), minlength=len(names)).astype(float)
    in_toxic = np.bincount(pairs % len(names), weights=y[pairs // len(names)], minlength=len(names))
    kept = (in_docs >= min_docs) & (evidence(in_toxic, in_docs, y.sum(), len(y)) >= least_evidence)
    place = np.cumsum(kept) - 1
    use = kept[at]
    at, sentence_of, names = place[at[use]], sentence_of[use], names[kept]

    # gradient steps with per-weight step sizes (Adam), whole sample each time
    theta = np.zeros(len(names) + 1)
    theta[-1] = start_bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(sentence_of, weights=theta[at], minlength=len(doc_of_sentence))
        total = np.bincount(doc_of_sentence, weights=softplus(z), minlength=len(y))
        slope = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0)
        back = slope[doc_of_sentence] * sigmoid(z)
        gradient = np.append(np.bincount(at, weights=back[sentence_of], minlength=len(names)), back.sum())
        gradient[:-1] += theta[:-1] / spread**2
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(names, theta[:-1], float(theta[-1]))


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", offending: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted, n_offending) for every row of docs, from the whole text alone.

    score: 0 to 1; predicted: 1 if it is 0.5 or more; n_offending: sentences that score `offending`
    or more. NULL and empty texts score as one sentence without known words. Equal texts score
    equally; an empty table gives no rows. The model (12 bytes a word of the sample) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts = [], []
            for text in batch.column(1).to_pylist():
                score, each = sent.value.score(text)
                scores.append(score)
                counts.append(int((each >= offending).sum()))
            predicted = [int(s >= 0.5) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(counts, pa.int64())], ["doc_id", "score", "predicted", "n_offending"])

    return docs.select(id_column, text_column).mapInArrow(rows, f"doc_id {kind}, score double, predicted int, n_offending long")


def offending_sentences(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, place, sentence, score) of every sentence that scores `least` or more; places count from 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                each = sent.value.sentence_scores(text)
                texts = sentence_texts(text or "")
                found += [(doc, int(i), texts[i], float(each[i])) for i in np.flatnonzero(each >= least)]
            columns = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column(0).type), *(pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.string(), pa.float64()), strict=True))], ["doc_id", "place", "sentence", "score"])

    return docs.select(id_column, text_column).mapInArrow(rows, f"doc_id {kind}, place long, sentence string, score double")
