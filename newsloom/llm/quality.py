"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is described by terms that do not depend on its language: runs of three
character classes (letters, capitals, digits, kinds of signs and of white
space), words that repeat the word before, and words that occurred before.  A
bounded, documented sample of labelled texts gives the weights of the terms and
a truncated singular value decomposition.  Its vectors and labels are broadcast
(at most ``max_labelled`` rows of ``dimensions`` floats); every document is
compared with all of them, in blocks, and the most similar ones vote with the
power of their cosine.

Defined cases: a null text is empty; an empty text has the zero vector, is as
close to every labelled text as to any other, and gets their mean label; labels
that are null are not used, labels of one document are averaged and rounded,
rows of a labelled document count once; without labelled rows every score is
0.5; ties among neighbours go by position in the sample; ids may repeat or be
null (then not held out); an empty table gives an empty result; other columns
are kept by ``kept`` and not looked at.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_slices

#: Documents of the labelled sample, neighbours that vote, and so on.
MAX_LABELLED, DIMENSIONS, NEIGHBOURS, POWER, THRESHOLD = 4096, 32, 15, 8, 0.3
_CLASSES = 12
_TRIPLES = _CLASSES**3
N_TERMS = _TRIPLES + 2
_SLICE = 1 << 20


def _byte_classes() -> np.ndarray:
    kinds = {" \t\r\x0b\x0c": 3, "\n": 4, ".,;:": 5, "!?": 6, "|/\\": 7, "()[]{}<>": 8, "'\"-_": 9}
    out = np.full(256, 10, np.int32)
    out[128:] = 0  # letters of other alphabets
    for b in range(128):
        c = chr(b)
        out[b] = (0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else
                  next((k for signs, k in kinds.items() if c in signs), 10 if c.isprintable() else 11))
    return out


_CLASS_OF = _byte_classes()


def shares(text: str) -> np.ndarray:
    """The share of each term: of class triples, and of words.

    A long text is read in slices; what crosses their borders is carried over
    (two classes, a word and the 64-bit hashes of the words so far), so the
    shares do not depend on where it is cut."""
    counts = np.zeros(N_TERMS)
    words, seen, last, rest = 0, set(), None, ""
    tail = np.zeros(0, np.int32)
    for first in range(0, len(text), _SLICE):
        part = text[first:first + _SLICE]
        kinds = np.append(tail, _CLASS_OF[np.frombuffer(part.encode(), np.uint8)])
        if len(kinds) > 2:
            triples = (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:]
            counts[:_TRIPLES] += np.bincount(triples, minlength=_TRIPLES)
        tail = kinds[-2:]
        own = (rest + part).split()
        # A word that the end of the slice may cut goes on in the next one.
        cut = first + _SLICE < len(text) and not part[-1].isspace()
        rest = own.pop() if cut else ""
        words += len(own)
        counts[_TRIPLES] += sum(map(operator.eq, own, own[1:])) + (own[:1] == [last])
        last = own[-1] if own else last
        seen.update(map(hash, own))
    counts[_TRIPLES + 1] = words - len(seen)
    counts[:_TRIPLES] /= max(counts[:_TRIPLES].sum(), 1)
    counts[_TRIPLES:] /= max(words, 1)
    return counts.astype(np.float32)


@dataclass(frozen=True)
class Voters:
    """The fitted model: term weights, projection, labelled vectors and labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    def latent(self, terms: np.ndarray) -> np.ndarray:
        out = (np.sqrt(terms) * self.weights) @ self.projection
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """A score in 0..1 for each row of term shares."""
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        cosines = self.latent(terms) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** self.power
        total = votes.sum(axis=1)
        score = np.where(total > 0, (votes * self.labels[near]).sum(axis=1)
                         / np.where(total > 0, total, 1), self.labels.mean())
        return np.clip(score, 0, 1)


def fit_voters(terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS,
               neighbours: int = NEIGHBOURS, power: float = POWER) -> Voters:
    """Weights and truncated decomposition (by subspace iteration) of the sample."""
    n = len(terms)
    weights = np.ones(N_TERMS, np.float32)
    weights[:_TRIPLES] += np.log((1 + n) / (1 + (terms[:, :_TRIPLES] > 0).sum(axis=0)))
    weighted = (np.sqrt(terms) * weights).astype(np.float64)
    basis = np.random.default_rng(6).normal(size=(N_TERMS, dimensions))
    for _ in range(12 if n else 0):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    model = Voters(weights, basis.astype(np.float32), np.zeros((0, dimensions), np.float32),
                   labels.astype(np.float64), neighbours, power)
    return Voters(weights, model.projection, model.latent(terms), model.labels, neighbours, power)


def held_out(doc_id: Column) -> Column:
    """One id in five, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
        id_column: str = "doc_id", text_column: str = "text", label: str = "quality") -> Voters:
    """Fit on the labelled documents with the smallest id hashes, ``max_labelled``
    of them; the driver sees that many rows and no more."""
    sample = (labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull()
                           & ~held_out(F.col(id_column)))
              .groupBy(F.col(id_column).alias("labelled_id"))
              .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_labelled))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            terms = [shares(t.as_py() or "").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.binary())],
                ["id", "label", "terms"])

    # At most max_labelled pairs of an id and a label: small by construction.
    rows = (texts.join(F.broadcast(sample), F.col("id") == F.col("labelled_id"))
            .select(F.col("id").cast("string").alias("id"), "label", "text")
            .mapInArrow(run, "id string, label int, terms binary")
            .groupBy("id", "label").agg(F.min("terms").alias("terms")).orderBy("id").collect())
    terms = np.stack([np.frombuffer(r.terms, np.float32) for r in rows]) if rows else np.zeros(
        (0, N_TERMS), np.float32)
    return fit_voters(terms, np.array([r.label for r in rows], float))


def _scores(texts: pa.Array, voters: Voters, block: int = 512) -> np.ndarray:
    parts = [voters.scores(np.stack([shares(t.as_py() or "") for t in texts.slice(a, block)]))
             for a in range(0, len(texts), block)]
    return np.concatenate(parts) if parts else np.zeros(0)


def scored(docs: DataFrame, voters: Voters, id_column: str = "doc_id", text_column: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(1), voters))], ["doc_id", "score"])

    return (docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def kept(docs: DataFrame, voters: Voters, text_column: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that the voters do not reject."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            yield batch.filter(pa.array(_scores(batch.column(at), voters) >= threshold))

    return docs.mapInArrow(run, docs.schema)
