"""Document probabilities under a lattice of subword pieces, and under add-one unigrams.

Each task numbers the distinct words of a block of documents and writes the
documents as numbers.  Words are counted over all blocks; a word's probability,
the sum over its segmentations, is computed once per distinct word of the corpus
and joined back to the blocks that hold it, where documents are summed up.  No
word list is sent to every task; only the vocabulary's weights are, whose number
the vocabulary fixes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.lattice import (
    Lattices,
    Vocabulary,
    add_expected,
    log_probabilities,
    prior_vocabulary,
    reweighted,
)
from tillweave.llm.tables import stored

#: A block is closed at so many bytes of text, or distinct words.
BLOCK_BYTES = 32 << 20
BLOCK_WORDS = 400_000

_BLOCK_SCHEMA = "block bigint, code int, word binary, n_train bigint, documents binary"
_OUT_SCHEMA = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, known_log double,"
    " lattice_log double"
)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed with the bytes of equal weight side by side."""
    import zstandard

    parts = [len(arrays).to_bytes(2, "little")]
    for array in arrays:
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
        raw = zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)
        parts += [array.dtype.str[1:].encode(), len(array).to_bytes(8, "little")]
        parts += [len(raw).to_bytes(8, "little"), raw]
    return b"".join(parts)


def _unpacked(raw: bytes) -> list[np.ndarray]:
    import zstandard

    out, at = [], 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind = np.dtype("<" + raw[at : at + 2].decode())
        count = int.from_bytes(raw[at + 2 : at + 10], "little")
        size = int.from_bytes(raw[at + 10 : at + 18], "little")
        planes = np.frombuffer(zstandard.decompress(raw[at + 18 : at + 18 + size]), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, count).T).view(kind).ravel())
        at += 18 + size
    return out


class _Block:
    """The words of a block so far, by number, and how often training documents hold them."""

    def __init__(self, number: int):
        self.number = number
        self.codes: dict[bytes, int] = {}
        self.n_train = np.zeros(0, np.int64)
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """One chunk (doc_id, text, held_out) as a row of packed documents."""
        text = W.words(batch.column(1), W.SPACED)
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        codes = self.codes
        number = np.fromiter(
            (codes.setdefault(w, len(codes)) for w in text.dictionary.to_pylist()),
            np.int64,
            len(text.dictionary),
        )
        grown = np.zeros(len(codes), np.int64)
        grown[: len(self.n_train)] = self.n_train
        owner = text.owner()
        code = number[text.codes] if len(number) else np.zeros(0, np.int64)
        pairs, times = np.unique(owner * np.int64(len(codes) + 1) + code, return_counts=True)
        doc, word = np.divmod(pairs, len(codes) + 1)
        train = held[doc] == 0
        np.add.at(grown, word[train], times[train])
        self.n_train = grown
        ids = batch.column(0)
        missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        packed = _packed(
            ids.fill_null(0).to_numpy(),
            missing,
            held,
            text.lengths().astype(np.int64),
            np.bincount(doc, minlength=batch.num_rows).astype(np.int32),
            word.astype(np.int32),
            times.astype(np.int32),
        )
        self.size += len(text.data)
        return _rows(self.number, [None], [None], [int((held == 0).sum())], [packed])

    def words(self) -> Iterator[pa.RecordBatch]:
        names = list(self.codes)
        for low in range(0, len(names), 50_000):
            part = names[low : low + 50_000]
            counts = self.n_train[low : low + 50_000]
            numbers = range(low, low + len(part))
            yield _rows(self.number, numbers, part, counts, [None] * len(part))


def _rows(block: int, codes, words, n_train, documents) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(words), pa.int64()),
            pa.array(codes, pa.int32()),
            pa.array(words, pa.binary()),
            pa.array(n_train, pa.int64()),
            pa.array(documents, pa.binary()),
        ],
        names=["block", "code", "word", "n_train", "documents"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 20
    block = None
    for batch in W.gathered(batches):
        block = block or _Block(base)
        yield block.add(batch)
        if block.size >= BLOCK_BYTES or len(block.codes) >= BLOCK_WORDS:
            yield from block.words()
            base += 1
            block = None
    if block:
        yield from block.words()


def trained_vocabulary(counts: DataFrame, n_ends: int, model_file: str, rounds: int) -> Vocabulary:
    """Piece weights after ``rounds`` of expectation over all (word, count) with a count."""
    prior = vocabulary = prior_vocabulary(model_file)
    context = counts.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(Lattices(vocabulary))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            into: dict[str, float] = {}
            for batch in batches:
                words = [w.decode("utf-8") for w in batch.column(0).to_pylist()]
                add_expected(words, batch.column(1).to_numpy(), shared.value, into)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(into), pa.string()), pa.array(list(into.values()), pa.float64())],
                names=["piece", "expected"],
            )

        rows = (
            counts.where("count > 0")
            .select("word", "count")
            .mapInArrow(expect, "piece string, expected double")
            .groupBy("piece")
            .agg(F.sum("expected").alias("expected"))
        )
        # At most one row per piece of the vocabulary.
        expected = {r.piece: r.expected for r in rows.collect()}
        vocabulary = reweighted(prior, expected, float(n_ends), smoothing=1000.0)
    return vocabulary


def _word_logs(vocabulary: Vocabulary, counts: DataFrame) -> DataFrame:
    """(word, count, lattice_log): base-10 logarithm of each word's probability."""
    shared = counts.sparkSession.sparkContext.broadcast(Lattices(vocabulary))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.decode("utf-8") for w in batch.column(0).to_pylist()]
            logs = log_probabilities(words, shared.value) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(logs, pa.float64())],
                names=["word", "count", "lattice_log"],
            )

    return counts.select("word", "count").mapInArrow(
        score, "word binary, count bigint, lattice_log double"
    )


def _sum_documents(documents: pa.Table, words: pa.Table) -> pa.Table:
    """Documents of one block, summed up from the logarithms of its words."""
    code = words.column("code").to_numpy()
    size = int(code.max()) + 1 if len(code) else 0
    count = np.zeros(size, np.int64)
    lattice = np.zeros(size)
    count[code] = words.column("count").to_numpy()
    lattice[code] = words.column("lattice_log").to_numpy()
    known = np.log10(count + 1.0)
    out = []
    for raw in documents.column("documents"):
        ids, missing, held, n_words, distinct, word, times = _unpacked(raw.as_py())
        owner = np.repeat(np.arange(len(ids)), distinct)

        def total(values, owner=owner, n=len(ids)):
            return np.bincount(owner, weights=values, minlength=n).astype(np.float64)

        n_known = total(times * (count[word] > 0)).astype(np.int64)
        out.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=missing.astype(bool)),
                    pa.array(held.astype(bool)),
                    pa.array(n_words),
                    pa.array(n_known),
                    pa.array(total(times * known[word])),
                    pa.array(total(times * lattice[word])),
                ],
                names=[
                    "doc_id", "held_out", "n_tokens", "n_known", "known_log", "lattice_log",
                ],
            )
        )
    return pa.Table.from_batches(out)


def scored(docs: DataFrame, model_file: str, rounds: int = 1) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, held_out): token counts and both log10 probabilities.

    Only rows with ``held_out`` false are learned from.  A null or empty text is
    the end token alone.  Null and repeated ids are passed on; repeated rows
    count as often as they occur.  An empty table gives no row.
    """
    blocks = stored(
        docs.select("doc_id", "text", "held_out").mapInArrow(_blocks, _BLOCK_SCHEMA), "lm-blocks"
    )
    documents = blocks.where("documents IS NOT NULL").select("block", "documents", "n_train")
    words = blocks.where("word IS NOT NULL").select("block", "code", "word", "n_train")
    counts = stored(words.groupBy("word").agg(F.sum("n_train").alias("count")), "lm-counts")
    totals = counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count_if(F.col("count") > 0).alias("v")
    ).first()
    ends = documents.agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n")).first().n
    n_train, distinct = totals.n + ends, totals.v + (ends > 0)
    vocabulary = trained_vocabulary(counts, ends, model_file, rounds)
    logs = _word_logs(vocabulary, counts)
    # Per block its words with their logarithms.
    valued = words.join(logs, "word").select("block", "code", "count", "lattice_log")
    sums = (
        documents.select(F.col("block").alias("of_block"), "documents")
        .groupBy("of_block")
        .cogroup(valued.groupBy("block"))
        .applyInArrow(_sum_documents, _OUT_SCHEMA)
    )
    base = math.log10(n_train + distinct + 1)
    n_tokens = F.col("n_tokens") + 1
    return sums.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(n_train)).cast("bigint").alias("train_tokens"),
        (F.col("known_log") + math.log10(ends + 1) - n_tokens * F.lit(base)).alias("base_score"),
        (F.col("lattice_log") + vocabulary.end / math.log(10)).alias("score"),
    )
