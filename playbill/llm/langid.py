"""Language identification by nearest centroids.

A text is a vector of hashed byte n-grams (two and three bytes of the lower-cased text, everything but
letters one blank), weighted by TF-IDF and normalised. Each language has several centroids, from
spherical k-means of labelled texts. The language of the nearest centroid by cosine wins; a text
too far from all of them, for its length, is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import join_bounded, tidy
from playbill.session import cut_lineage

BUCKETS = 1 << 14
UNKNOWN = "und"
# ASCII letters in lower case and bytes above ASCII stay, the rest is a blank
FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
BLANKS = re.compile(rb"  +")
LETTER = re.compile(r"[^\W\d_]")


def grams_of(text: str) -> np.ndarray:
    """Buckets of the n-grams of the whole text, with repeats; empty without a letter."""
    if not LETTER.search(text):
        return np.empty(0, np.int64)
    folded = BLANKS.sub(b" ", b" " + text.lower().encode().translate(FOLD) + b" ")
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    found = np.concatenate([two + np.uint32(0x5BD1E995), three]) * np.uint32(0x9E3779B1)
    return (found >> np.uint32(32 - 14)).astype(np.int64)


def tf_vector(buckets: np.ndarray) -> np.ndarray:
    """1 + log of the counts."""
    counts = np.bincount(buckets, minlength=BUCKETS).astype(np.float32)
    seen = counts > 0
    counts[seen] = 1 + np.log(counts[seen])
    return counts


def normalised(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-12)


def size_class(n_grams: int) -> int:
    """Texts are compared with texts of about their length: a class for each doubling."""
    return min(int(n_grams).bit_length(), 24)


@dataclass
class Model:
    """`floor[c]` is the least cosine at which a text of size class c is accepted."""

    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine to the nearest centroid, and whether the text is rejected."""
        names, scores, rejected = [], [], []
        for a in range(0, len(texts), 64):
            found = [grams_of(text) if text else np.empty(0, np.int64) for text in texts[a : a + 64]]
            vectors = normalised(np.stack([tf_vector(x) for x in found]) * self.idf)
            cosines = vectors @ self.centroids.T if len(self.owner) else np.zeros((len(found), 0), np.float32)
            for x, row in zip(found, cosines, strict=True):
                if not len(x) or not len(row):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best = int(row.argmax())
                score = float(min(1.0, max(0.0, row[best])))
                names.append(self.languages[self.owner[best]])
                scores.append(score)
                rejected.append(score < self.floor[size_class(len(x))])
        return names, scores, rejected


def spherical_means(vectors: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """k centroids of unit vectors; starts from rows far from each other."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centers = vectors[chosen]
    for _ in range(rounds):
        owner = (vectors @ centers.T).argmax(axis=1)
        centers = normalised(np.stack([vectors[owner == j].sum(axis=0) if (owner == j).any() else centers[j] for j in range(len(centers))]))
    return centers


def sample(labelled: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most `per_label` rows for each label, the same ones in every run: rows whose hashed key is
    small enough for the label's counted number, then the first of them. Only labels are counted
    and only hashes compared, so no label is gathered anywhere."""
    share = labelled.groupBy(label).agg((F.lit(per_label * 1.2 + 30) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = join_bounded(labelled, cut_lineage(share), [label], "inner", 60).where(draw < F.col("share")).drop("share")
    order = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    return some.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_label).drop("_n")


def fit(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", key_column: str = "doc_id",
        per_language: int = 300, clusters: int = 4, quantile: float = 0.002, slack: float = 0.5) -> Model:
    """Fit on a bounded sample of `per_language` labelled rows a language, whole texts; rows without
    a text, a letter or a label teach nothing. With no rows at all the model rejects everything.

    The floor of a size class is `slack` times the `quantile` of the cosines of sample texts, and of
    pieces of them, of that size: what lies far below all that was seen in any language.
    """
    rows = labelled.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(key_column).alias("key"), F.col(label_column).alias("label"), F.col(text_column).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                buckets = grams_of(text).astype(np.int16)
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.string()), pa.array([buckets.tobytes()], pa.binary())], ["label", "buckets"])

    taken = cut_lineage(sample(rows, "label", "key", per_language).select("label", "text").mapInArrow(counted, "label string, buckets binary"))
    found: dict[str, list[np.ndarray]] = {}
    for label, data in taken.orderBy("label", F.xxhash64("buckets"), "buckets").toLocalIterator():
        buckets = np.frombuffer(data, np.int16).astype(np.int64)
        if len(buckets):
            found.setdefault(label, []).append(buckets)
    languages = sorted(found)
    n = sum(map(len, found.values()))
    present = np.zeros(BUCKETS)
    for buckets in (b for group in found.values() for b in group):
        present[np.unique(buckets)] += 1
    idf = np.log((1 + n) / (1 + present)).astype(np.float32) + np.float32(0.1)
    owner, centers = [], []
    for i, language in enumerate(languages):
        vectors = normalised(np.stack([tf_vector(b) for b in found[language]]) * idf)
        means = spherical_means(vectors, clusters)
        owner += [i] * len(means)
        centers.append(means)
    model = Model(languages, np.array(owner, np.int64), np.concatenate(centers).astype(np.float32) if centers else np.zeros((0, BUCKETS), np.float32), idf, np.zeros(25))
    cosines: dict[int, list[float]] = {}
    for buckets in (b for group in found.values() for b in group):
        half = len(buckets) // 2 + 1  # pairs first, then triples
        for size in (len(buckets), *(1 << p for p in range(3, 12))):
            if size > len(buckets):
                continue
            part = buckets if size == len(buckets) else np.concatenate([buckets[: size // 2], buckets[half : half + size // 2]])
            vector = normalised(tf_vector(part) * idf)
            cosines.setdefault(size_class(len(part)), []).append(float((model.centroids @ vector).max()))
    for c in range(25):
        if c in cosines:
            model.floor[c] = slack * float(np.quantile(cosines[c], quantile))
        else:
            model.floor[c] = model.floor[c - 1] if c > 4 else 0.0
    return model


def identified(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of docs, from the whole text alone.

    NULL texts and texts without a letter are `und` with score 0 and rejected. Equal texts get equal
    answers; an empty table gives no rows. The model (languages * clusters * 64 KB) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = sent.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(id_column, text_column).mapInArrow(tidy(rows), f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of docs, with their columns, whose text the model does not reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = sent.value.predict(batch.column(place).to_pylist())[2]
            yield batch.filter(pa.array([not x for x in rejected], pa.bool_()))

    return docs.mapInArrow(tidy(rows), docs.schema)
