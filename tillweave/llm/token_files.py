"""Token ids of documents in files of patched frame-of-reference blocks.

Documents are dealt by ranges of doc_id and sorted, encoded with a public
tokenizer and written as rows of segments: the blocks of some hundred thousand
ids, the index of block starts, and the ids and lengths of the documents within.
The place of a document in the whole sequence is the sum of the shards before
its own, of the segments before its own in the shard, and of the documents
before it in the segment.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillweave.llm import frames
from tillweave.llm import words as W
from tillweave.session import scratch_path

#: A segment is closed at the end of the document that brings it to so many ids.
SEGMENT_IDS = 1 << 18
#: Pieces of text whose ids a worker keeps; beyond that it keeps the half that more chunks hold.
CACHE_PIECES = 400_000
#: Pieces that go through one call of the tokenizer.
LOT_PIECES = 1_000
#: Bytes of text that are encoded at once; one longer text is encoded alone.
CHUNK_BYTES = 2 << 20

SEGMENT_SCHEMA = (
    "shard int, segment int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint,"
    " block_starts binary, blocks binary"
)

# 1: a-z and A-Z.  2: signs that never share a token with a letter beside them.  The apostrophe
# starts contractions, and < | > special tokens, so these stay with what is around them.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[ord(c) for c in '.,;:!?"()*%&$#@/+=_~[]{}-\\^`']] = 2
#: A sign that is a word of its own between spaces, and rare in texts.
_PART = "\x01"
#: Letters only, all of them still one letter when composed and lower-cased: no \u0130.
_WORD = "^[A-Za-zÀ-ÖØ-öø-įı-žА-Яа-яЁё]+$"
_LOWER = W.SPACED
_AS_IS = W.byte_table([0x20, *range(0x09, 0x0E)], lower=False)


# The normaliser and splitter for which cutting and lowering pieces changes no id.
_LOWERED = ["NFC", "Replace", "Lowercase"]
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_alike(path: str) -> bool:
    """Whether the tokenizer of a file splits and lower-cases in the way that pieces presuppose."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    normal = (made.get("normalizer") or {}).get("normalizers") or []
    split = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        [n["type"] for n in normal] == _LOWERED
        and split[0].get("pattern") == {"Regex": _SPLITTER}
        and bool(split[0].get("invert"))
    )


def _hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece; pieces are not empty."""
    lengths = np.diff(bounds)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    terms = powers[W.ragged(np.zeros(len(lengths), np.int64), lengths)]
    terms *= data + np.uint64(1)
    return np.add.reduceat(terms, bounds[:-1]) * np.uint64(0xD6E8FEB86659FD93)


def _picked(values: np.ndarray, bounds: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some runs, one after another, and their bounds."""
    lengths = np.diff(bounds)[some]
    return values[W.ragged(bounds[some], lengths)], np.append(0, np.cumsum(lengths))


class PieceTable:
    """Pieces and their ids in flat arrays, found by hash and then compared byte by byte.

    Piece i has ``ids[id_bounds[i]:id_bounds[i + 1]]`` and was asked for in
    ``uses[i]`` chunks, of which every ``thin`` forgets half.
    """

    def __init__(self) -> None:
        self.text, self.text_bounds = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.hashes, self.uses = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._sort()

    def __len__(self) -> int:
        return len(self.hashes)

    def _sort(self) -> None:
        self.order = np.argsort(self.hashes).astype(np.int32)

    def find(self, data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Place of each piece, -1 where it is not held.

        Of several pieces that share a hash only one is found; the others count as new each time.
        """
        place = np.full(len(hashes), -1, np.int64)
        if not len(self):
            return place
        at = np.searchsorted(self.hashes, hashes, sorter=self.order)
        near = self.order[np.minimum(at, len(self) - 1)].astype(np.int64)
        lengths = np.diff(bounds)
        alike = np.flatnonzero(
            (self.hashes[near] == hashes) & (np.diff(self.text_bounds)[near] == lengths)
        )
        if len(alike):
            held, own = _picked(self.text, self.text_bounds, near[alike])
            equal = held == _picked(data, bounds, alike)[0]
            alike = alike[np.logical_and.reduceat(equal, own[:-1])]
            place[alike] = near[alike]
        return place

    def add(self, data, bounds, hashes, ids, lengths) -> np.ndarray:
        """Takes pieces in, with the ids of each; their places."""
        before = len(self)
        self.text = np.concatenate([self.text, data])
        self.text_bounds = np.concatenate([self.text_bounds, self.text_bounds[-1] + bounds[1:]])
        self.ids = np.concatenate([self.ids, ids])
        self.id_bounds = np.concatenate([self.id_bounds, self.id_bounds[-1] + np.cumsum(lengths)])
        ranks = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[ranks], sorter=self.order)
        self.order = np.insert(self.order, at, (before + ranks).astype(np.int32))
        self.hashes = np.concatenate([self.hashes, hashes])
        self.uses = np.concatenate([self.uses, np.zeros(len(hashes), np.int32)])
        return np.arange(before, len(self))

    def thin(self, size: int) -> None:
        """Keeps the ``size`` pieces that most chunks asked for."""
        if len(self) <= size:
            return
        kept = np.sort(np.argpartition(-self.uses, size)[:size])
        self.text, self.text_bounds = _picked(self.text, self.text_bounds, kept)
        self.ids, self.id_bounds = _picked(self.ids, self.id_bounds, kept)
        self.hashes, self.uses = self.hashes[kept], self.uses[kept] // 2
        self._sort()


class PieceEncoder:
    """Encodes texts by way of their distinct pieces.

    The tokenizer cuts a text at white space and between letters and other
    signs before it looks at tokens, so the ids of a text are the ids of its
    pieces in order, and each distinct piece is given to the tokenizer once, as
    long as it is kept.  Pieces are lowered first, as the tokenizer does itself,
    unless the text may hold a special token, whose case counts.  A tokenizer
    that works otherwise is given whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = cuts_alike(path)
        self.table = PieceTable()
        # The id of the parting sign, which is a word of its own between spaces.
        parting = self.tokenizer.encode(_PART, add_special_tokens=False).ids
        self.part_id = parting[0] if len(parting) == 1 else None
        # Tokens that end a word, where each byte has one and so each word ends with one.
        self.ends = None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        if suffix and all(c + suffix in vocabulary for c in pre_tokenizers.ByteLevel.alphabet()):
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, np.uint32) for c in coded]

    def _encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces, their ids in this order, and the number of ids of each.

        Many pieces go through one call: words of letters with spaces between them, the others
        parted by a sign as well, which stands in none of them.
        """
        texts = pieces.cast(pa.large_string())
        words = np.zeros(len(texts), bool)
        if self.ends is not None:
            words = pc.match_substring_regex(texts, _WORD).to_numpy(zero_copy_only=False)
        alone = np.ones(len(texts), bool)
        if self.part_id is not None:
            alone = pc.match_substring(texts, _PART).to_numpy(zero_copy_only=False)
        groups = [np.flatnonzero(g) for g in (words, ~words & ~alone, ~words & alone)]
        ids, lengths = [], []
        for group, part in zip(groups, (" ", f" {_PART} ", None)):
            own = texts.take(pa.array(group)).to_pylist()
            if part is None:
                for found in self._ids(own):
                    ids.append(found)
                    lengths.append([len(found)])
                continue
            for start in range(0, len(own), LOT_PIECES):
                (found,) = self._ids([part.join(own[start : start + LOT_PIECES])])
                if part == " ":
                    lengths.append(np.diff(np.flatnonzero(self.ends[found]), prepend=-1))
                else:
                    at = np.flatnonzero(found == self.part_id)
                    lengths.append(np.diff(np.append(at, len(found)), prepend=-1) - 1)
                    found = np.delete(found, at)
                ids.append(found)
        return np.concatenate(groups), np.concatenate(ids), np.concatenate(lengths)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each of some distinct pieces stands in the table, which learns the new ones."""
        if len(self.table) > CACHE_PIECES:
            self.table.thin(CACHE_PIECES // 2)
        if not len(pieces):
            return np.zeros(0, np.int64)
        data, bounds = W.raw_bytes(pieces)
        hashes = _hashes(data, bounds)
        place = self.table.find(data, bounds, hashes)
        new = np.flatnonzero(place < 0)
        if len(new):
            order, ids, lengths = self._encode_pieces(pieces.take(pa.array(new)))
            new = new[order]
            place[new] = self.table.add(*_picked(data, bounds, new), hashes[new], ids, lengths)
        self.table.uses[place] += 1
        return place

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with ``end_id`` after each text, and the number of ids of each text."""
        if not self.by_pieces:
            coded = self.tokenizer.encode_batch_fast(
                [t or "" for t in texts.to_pylist()], add_special_tokens=False
            )
            ids = [[*c.ids, end_id] for c in coded]
            counts = np.array([len(i) for i in ids], np.int64)
            return np.array([i for own in ids for i in own], np.uint32), counts
        data, bounds = W.raw_bytes(texts)
        kind = _KIND[data]
        edge = np.zeros(len(data), bool)
        if len(data):
            edge[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        special = b"<|" in data.tobytes()
        cut = W.cut(data, bounds, _AS_IS if special else _LOWER, edge)
        place = self._places(cut.dictionary)
        # The end id is one more piece, after the last one of each text.
        ids = np.append(self.table.ids, np.uint32(end_id))
        starts = np.append(self.table.id_bounds[place], len(ids) - 1)
        lengths = np.append(np.diff(self.table.id_bounds)[place], 1)
        codes = np.insert(cut.codes, cut.first[1:], len(place))
        sizes = lengths[codes]
        last = np.flatnonzero(codes == len(place))
        counts = np.diff(np.cumsum(sizes)[last], prepend=0)
        return ids[W.ragged(starts[codes], sizes)], counts


def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer."""
    return W.kept(path, lambda: PieceEncoder(path))


def _segment_batch(shard, number, doc_ids, lengths, ids) -> pa.RecordBatch:
    values = np.concatenate(ids)
    blocks, starts = frames.encode(values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([len(values)], pa.int64()),
            pa.array([starts.astype("<u4").tobytes()], pa.binary()),
            pa.array([blocks.tobytes()], pa.binary()),
        ],
        names=["shard", "segment", "doc_ids", "lengths", "n_ids", "block_starts", "blocks"],
    )


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order to segment files at ``path``.

    A null text is empty: its document is the end id alone.  A null doc_id comes
    first.  Rows that repeat a doc_id stay, in the order of their texts' hashes.
    An empty table writes no segment.  A segment ends with a document, so a very
    long one makes a long segment.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(tokenizer)
        shard, number, held = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        lengths: list = []
        ids: list = []
        for batch in W.gathered(batches, size=CHUNK_BYTES, keeps=tokenizer):
            coded, counts = encoder.encode(batch.column(1), end_id)
            ends = np.cumsum(counts)
            names = batch.column(0).to_pylist()
            start = 0
            while start < len(names):
                base = int(ends[start - 1]) if start else 0
                stop = int(np.searchsorted(ends, base + SEGMENT_IDS - held)) + 1
                stop = min(stop, len(names))
                top = int(ends[stop - 1])
                doc_ids += names[start:stop]
                lengths += counts[start:stop].tolist()
                ids.append(coded[base:top])
                held += top - base
                start = stop
                if held >= SEGMENT_IDS:
                    yield _segment_batch(shard, number, doc_ids, lengths, ids)
                    number, held, doc_ids, lengths, ids = number + 1, 0, [], [], []
        if doc_ids:
            yield _segment_batch(shard, number, doc_ids, lengths, ids)

    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
        .mapInArrow(encode, SEGMENT_SCHEMA)
        .write.parquet(path)
    )


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def segment_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each segment: (shard, segment, before)."""
    sizes = _segments(spark, path).select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, that is per task of the write.
    shards = shards.select("shard", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard").orderBy("segment")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(shards, "shard").select(
        "shard",
        "segment",
        (F.col("_base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("before"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.drop_kept()
        for batch in batches:
            for row in range(batch.num_rows):
                shard, segment, doc_ids, lengths, starts, blocks = (
                    batch.column(i)[row] for i in range(6)
                )
                ids = frames.decode(
                    np.frombuffer(blocks.as_buffer(), np.uint8),
                    np.frombuffer(starts.as_buffer(), "<u4"),
                )
                sizes = lengths.values.to_numpy()
                raw = ids.astype("<u4")
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends, sizes)]
                count = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, shard.as_py(), np.int32)),
                        pa.array(np.full(count, segment.as_py(), np.int32)),
                        doc_ids.values,
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["shard", "segment", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    rows = _segments(spark, path).select(
        "shard", "segment", "doc_ids", "lengths", "block_starts", "blocks"
    )
    rows = rows.mapInArrow(
        summed,
        "shard int, segment int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return rows.join(segment_offsets(spark, path), ["shard", "segment"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read each document back.

    Nulls, empty and repeated rows, long texts and empty tables as in
    ``write_tokens``; columns other than doc_id and text are not looked at.
    """
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
