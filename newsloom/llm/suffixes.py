"""Removal of repeated byte strings by difference-cover blockwise suffix order.

A byte goes if a string of ``length`` (200) bytes that covers it also starts
somewhere else.  Documents are packed into chunks of bounded size.

1. Cover sample.  In each document the positions whose remainder modulo 133 is
   in a perfect difference cover are sampled: 12 of 133.  For any two places of
   equal 200-byte strings, a pair of samples at the same distance (below 133)
   from them starts equal strings of 68 bytes.  These sample windows are dealt
   into buckets, one bucket is sorted at a time, and equal neighbours share a
   rank.  A sample whose rank is its own has no equal anywhere.
2. Suffixes.  A suffix is worth sorting only if, within its first 133 bytes, a
   sample shares its rank with another; all other ties are excluded by the
   ranks of step 1.  These suffixes are dealt into buckets by their first 200
   bytes, again one bucket is sorted at a time, and equal neighbours tie.
3. Every tied suffix removes its first 200 bytes.

Buckets order suffixes by a 64-bit fingerprint of their prefix, not by its
bytes: only ties are asked for, and a prefix would cost 200 bytes to move.
Windows are fingerprinted from prefix sums, so a position costs the same in
long and short texts.  A chunk names each fingerprint once, so a passage that
very many documents share is one entry per chunk, and a document that equals
another one as a whole is sorted once for all its copies.  What comes back to a
chunk is one bit per entry.

Defined cases: a null text is empty; a text below 200 bytes loses nothing; ids
may be null or repeated, each row counts as a document of its own; exact copies
of 200 bytes or more go as a whole, all of them; an empty table gives an empty
result; other columns are kept.
"""

from __future__ import annotations

import functools
import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage, new_work_path
from .common import release_memory

LENGTH = 200
#: A perfect difference cover: each remainder is a difference of two members.
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
#: Two samples at the same distance start this many equal bytes at least.
WINDOW = LENGTH - PERIOD + 1
#: Text in one chunk.  A worker's memory follows it: about 90 bytes for each byte
#: of a chunk in which everything repeats (tested).
CHUNK_BYTES = 2 << 20
#: Chunks that one task works through, one after the other.
TASK_CHUNKS = 16
#: Entries that a bucket is meant to hold; the number of buckets follows the input.
BUCKET_ENTRIES = 1 << 20
_SLICE = 1 << 20
_SAMPLES, _DOCUMENTS, _SUFFIXES = 0, 1, 2


# --- fingerprints of windows --------------------------------------------------

@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers for bytes; powers of an odd base and their inverses modulo 2^64."""
    random = np.random.default_rng(20)
    letters = random.integers(0, 1 << 64, 256, dtype=np.uint64)
    base = int(random.integers(0, 1 << 62)) * 4 + 3

    def powers(of: int) -> np.ndarray:
        out = np.empty(_SLICE + LENGTH + 1, np.uint64)
        out[0], have = 1, 1
        while have < len(out):
            n = min(have, len(out) - have)
            out[have:have + n] = out[:n] * np.uint64(pow(of, have, 1 << 64))
            have += n
        return out

    return letters, powers(base), powers(pow(base, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_prints(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of data[s : s + width] for sorted starts; equal strings are equal."""
    letters, powers, inverse = _tables()
    out = np.empty(len(starts), np.uint64)
    for first in range(0, len(data), _SLICE):
        a, b = np.searchsorted(starts, [first, first + _SLICE])
        if a == b:
            continue
        own = starts[a:b] - first
        values = letters[data[first:first + int(own[-1]) + width]]
        values *= powers[:len(values)]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        out[a:b] = _mixed((sums[own + width] - sums[own]) * inverse[own])
    return out


# --- chunks ---------------------------------------------------------------------

def _pack(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, batches[0].schema, options=options) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packed(docs: DataFrame, text_column: str, chunk_bytes: int) -> DataFrame:
    """(chunk, body): compressed Arrow rows of about ``chunk_bytes`` of text."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | seq], pa.int64()), pa.array([_pack(held)], pa.binary())],
                ["chunk", "body"])

        for batch in batches:
            sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0
                               for t in batch.column(at).cast(pa.binary())])
            first = 0
            while first < batch.num_rows:
                before = int(sizes[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(
                    sizes, before + chunk_bytes - size, side="right")))
                held.append(batch.slice(first, last - first))
                size += int(sizes[last - 1]) - before
                first = last
                if size >= chunk_bytes or first < batch.num_rows:
                    yield chunk()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield chunk()

    return docs.mapInArrow(run, "chunk long, body binary")


@dataclass
class Chunk:
    """The rows of a chunk and its texts as one byte array."""

    rows: pa.Table
    data: np.ndarray
    bounds: np.ndarray  # where each document starts, and the end

    @classmethod
    def open(cls, body: bytes, text_column: str) -> Chunk:
        rows = pa.ipc.open_stream(body).read_all().combine_chunks()
        texts = rows.column(text_column).cast(pa.large_binary()).fill_null(b"")
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        if not len(texts):
            return cls(rows, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(rows, whole[bounds[0]:bounds[-1]], bounds - bounds[0])

    def samples(self) -> np.ndarray:
        """Positions of the cover sample that have a whole window."""
        cover = np.array(COVER)
        parts = []
        for start, stop in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()):
            usable = stop - start - WINDOW + 1
            if usable > 0:
                places = (np.arange(0, usable, PERIOD)[:, None] + cover).ravel()
                parts.append(places[:np.searchsorted(places, usable)] + start)
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def long_documents(self) -> np.ndarray:
        return np.nonzero(np.diff(self.bounds) >= LENGTH)[0]

    def document_prints(self, long: np.ndarray) -> np.ndarray:
        digests = [hashlib.blake2b(self.data[self.bounds[i]:self.bounds[i + 1]],
                                   digest_size=8).digest() for i in long]
        return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64)


# --- entries of a chunk and the bits that come back ----------------------------

@dataclass
class Entries:
    """Distinct fingerprints of a chunk in order, and which of them each place has."""

    values: np.ndarray
    place: np.ndarray
    repeated: np.ndarray

    @classmethod
    def of(cls, prints: np.ndarray) -> Entries:
        order = np.argsort(prints, kind="stable").astype(np.int32)
        values = prints[order]
        new = np.append(True, values[1:] != values[:-1])[:len(values)]
        values = values[new]
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        return cls(values, place, np.bincount(place, minlength=len(values)) > 1)

    def rows(self, chunk: int, kind: int, bits: int, width: int) -> Iterator[tuple]:
        """One row per bucket that occurs: the values below the bucket's bits,
        most significant bytes first and together, as they are sorted."""
        buckets = self.values >> np.uint64(64 - bits)
        starts = np.nonzero(np.append(True, buckets[1:] != buckets[:-1]))[0] if len(buckets) else []
        for first, last in zip(starts, np.append(starts[1:], len(buckets))):
            cut = (self.values[first:last] << np.uint64(bits)).astype(">u8")
            planes = cut.view(np.uint8).reshape(-1, 8)[:, :width].T
            yield chunk, kind, int(buckets[first]), int(last - first), planes.tobytes()


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["chunk", "kind", "bucket", "n", "planes"])


_ENTRIES = "chunk long, kind int, bucket int, n long, planes binary"
_ANSWERS = "chunk long, kind int, bucket int, n long, shared binary, first binary"


def sorted_bucket(rows: pa.Table) -> pa.Table:
    """Sort one bucket; say of each entry whether it shares its rank with
    another chunk's, and whether it is the first of that rank."""
    rows = rows.sort_by("chunk")
    sizes = rows.column("n").to_numpy()
    values = np.zeros(int(sizes.sum()), np.uint64)
    at = 0
    for n, planes in zip(sizes.tolist(), rows.column("planes")):
        grid = np.frombuffer(planes.as_buffer(), np.uint8).reshape(-1, n)
        for line in grid:
            values[at:at + n] = values[at:at + n] << np.uint64(8) | line
        at += n
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    last = np.ones(len(ranked), bool)
    last[:-1] = new[1:]
    shared, first = np.empty(len(ranked), bool), np.empty(len(ranked), bool)
    shared[order], first[order] = ~(new & last), new
    ends = np.cumsum(sizes)
    cut = [(a, b) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
    return pa.table({
        "chunk": rows.column("chunk"), "kind": rows.column("kind"),
        "bucket": rows.column("bucket"), "n": rows.column("n"),
        "shared": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in cut], pa.binary()),
        "first": pa.array([np.packbits(first[a:b]).tobytes() for a, b in cut], pa.binary())})


def _answers(entries: DataFrame, name: str) -> DataFrame:
    return cut_lineage(entries.groupBy("kind", "bucket").applyInArrow(sorted_bucket, _ANSWERS),
                       name)


def _bits(answers: pa.Table, kind: int, column: str) -> np.ndarray:
    """The bits of all entries of one kind, in the order of the entries."""
    own = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("bucket")
    parts = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n)
             for n, x in zip(own.column("n").to_pylist(), own.column(column))]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


@dataclass
class Candidates:
    """What the ranks of the samples leave of a chunk."""

    suffixes: np.ndarray   # positions to sort
    whole: np.ndarray      # documents that equal another one


def _candidates(chunk: Chunk, answers: pa.Table) -> Candidates:
    samples = chunk.samples()
    entries = Entries.of(window_prints(chunk.data, samples, WINDOW))
    tied = samples[(_bits(answers, _SAMPLES, "shared") | entries.repeated)[entries.place]]
    del samples, entries
    long = chunk.long_documents()
    documents = Entries.of(chunk.document_prints(long))
    shared = (_bits(answers, _DOCUMENTS, "shared") | documents.repeated)[documents.place]
    # Of equal documents, one stands for all: the first of the first chunk.
    _, leaders = np.unique(documents.place, return_index=True)
    stands = np.zeros(len(long), bool)
    stands[leaders] = _bits(answers, _DOCUMENTS, "first")
    sorted_for_others = long[shared & ~stands]
    parts = []
    cuts = np.searchsorted(tied, chunk.bounds)
    skipped = np.zeros(len(chunk.bounds) - 1, bool)
    skipped[sorted_for_others] = True
    for i in long:
        own = tied[cuts[i]:cuts[i + 1]]
        if len(own) and not skipped[i]:
            start, usable = int(chunk.bounds[i]), int(chunk.bounds[i + 1] - chunk.bounds[i]) - LENGTH + 1
            steps = np.zeros(usable + 1, np.int32)
            np.add.at(steps, np.minimum(np.maximum(own - start - PERIOD + 1, 0), usable), 1)
            np.add.at(steps, np.minimum(own - start + 1, usable), -1)
            parts.append(np.nonzero(np.cumsum(steps[:-1], dtype=np.int32))[0] + start)
            del steps
    return Candidates(np.concatenate(parts) if parts else np.zeros(0, np.int64), long[shared])


def _removed(chunk: Chunk, answers: pa.Table) -> np.ndarray:
    """Which bytes of the chunk go."""
    found = _candidates(chunk, answers)
    entries = Entries.of(window_prints(chunk.data, found.suffixes, LENGTH))
    tied = found.suffixes[(_bits(answers, _SUFFIXES, "shared") | entries.repeated)[entries.place]]
    steps = np.zeros(len(chunk.data) + 1, np.int32)
    steps[tied] += 1
    np.add.at(steps, tied + LENGTH, -1)
    steps[chunk.bounds[found.whole]] += 1
    np.add.at(steps, chunk.bounds[found.whole + 1], -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


# --- the jobs -----------------------------------------------------------------

def _stored_chunks(docs: DataFrame, text_column: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Chunks as a table bucketed by chunk, so that answers come to the texts
    and texts are not moved again; and the bits of a bucket number."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    name = f"newsloom_chunks_{uuid.uuid4().hex}"
    tasks = min(100_000, max(1, math.ceil(total / (TASK_CHUNKS * chunk_bytes))))
    (packed(docs, text_column, chunk_bytes).write.format("parquet")
     .option("compression", "none").option("path", new_work_path(spark, "chunks"))
     .bucketBy(tasks, "chunk").saveAsTable(name))
    chunks = spark.table(name)
    # Plans keep the files and their buckets; the name is no longer needed.
    spark.sql(f"DROP TABLE {name}")
    entries = max(1, total * len(COVER) // PERIOD)
    return chunks, max(3, math.ceil(math.log2(entries / BUCKET_ENTRIES + 1)))


def without_repeats(docs: DataFrame, text_column: str, finish: Callable[[Chunk, np.ndarray],
                    pa.Table], schema: str | StructType, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``finish`` of every chunk with the mask of its removed bytes."""
    chunks, bits = _stored_chunks(docs, text_column, chunk_bytes)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = Chunk.open(body.as_buffer(), text_column)
                yield _entry_batch(list(Entries.of(window_prints(
                    chunk.data, chunk.samples(), WINDOW)).rows(number, _SAMPLES, bits, 4)))
                yield _entry_batch(list(Entries.of(chunk.document_prints(
                    chunk.long_documents())).rows(number, _DOCUMENTS, bits, 8)))
                del chunk
            release_memory()

    def suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for number, body in zip(left.column(0).to_pylist(), left.column(1)):
            chunk = Chunk.open(body.as_buffer(), text_column)
            found = _candidates(chunk, right)
            rows += Entries.of(window_prints(chunk.data, found.suffixes, LENGTH)).rows(
                number, _SUFFIXES, bits, 8)
            del chunk, found
        release_memory()
        return pa.Table.from_batches([_entry_batch(rows)])

    def finished(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for body in left.column(1):
            chunk = Chunk.open(body.as_buffer(), text_column)
            tables.append(finish(chunk, _removed(chunk, right)))
            del chunk
        release_memory()
        return pa.concat_tables(tables)

    def joined(answers: DataFrame, run, out) -> DataFrame:
        return (chunks.select("chunk", "body").groupBy("chunk")
                .cogroup(answers.groupBy("chunk")).applyInArrow(run, out))

    ranks = _answers(chunks.select("chunk", "body").mapInArrow(sample, _ENTRIES), "sample-ranks")
    ties = _answers(joined(ranks, suffixes, _ENTRIES), "suffix-ties")
    return joined(ranks.unionByName(ties), finished, schema)


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and kept_sha256."""
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def finish(chunk: Chunk, removed: np.ndarray) -> pa.Table:
        sizes, gone, spans, digests = [], [], [], []
        for a, b in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist()):
            mask = removed[a:b]
            sizes.append(b - a)
            gone.append(int(mask.sum()))
            spans.append(int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum()))
            kept = chunk.data[a:b] if not gone[-1] else chunk.data[a:b][~mask]
            digests.append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": chunk.rows.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
                         "n_removed": pa.array(gone, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    return without_repeats(narrow, "text", finish, f"doc_id {kind}, n_bytes long, n_removed long, "
                                                   "n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with all their columns, repeated strings cut out of the
    text.  A character of which a cut leaves only some bytes goes with it."""
    def finish(chunk: Chunk, removed: np.ndarray) -> pa.Table:
        at = chunk.rows.schema.get_field_index(text_column)
        before = chunk.rows.column(at)
        texts = []
        for i, (a, b) in enumerate(zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist())):
            mask = removed[a:b]
            texts.append(chunk.data[a:b][~mask].tobytes().decode("utf-8", "ignore")
                         if mask.any() else before[i].as_py())
        return chunk.rows.set_column(at, chunk.rows.schema.field(at).name,
                                     pa.array(texts, before.type))

    return without_repeats(docs, text_column, finish, docs.schema)
