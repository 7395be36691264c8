"""SimHash fingerprints linked by anchor points of a covering code.

A fingerprint is cut into segments.  With thresholds t_i of which the sum of
(t_i + 1) exceeds the distance, two fingerprints within that distance differ in
at most t_i bits of some segment i.  The anchors of a segment are the words of a
covering code: shortened to the segment, a Hamming code reaches every word
within ``RADIUS``.  A fingerprint lives at its nearest anchor, its home, and is
copied to every anchor within ``RADIUS + t_i``; the home of a neighbour is one of
them.  Only what meets at an anchor is compared, on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.components import components
from tillweave.llm.forest import DisjointSets, spanning_links
from tillweave.llm.tables import stored

SHINGLE = 4
SEED = 42
DISTANCE = 4
RADIUS = 1
#: Bits of the segments, from the low end, and the bits they may differ in.
SEGMENTS = ((21, 1), (21, 1), (22, 0))
#: Parity bits of the Hamming part of each segment; its 2**r - 1 bits come first.
PARITY = 4
#: Fingerprints that one comparing task holds of an anchor; hotter anchors are split.
HELD = 1 << 15
#: Bytes of text hashed at once; each shingle takes some hundred bytes meanwhile.
HASHED_BYTES = 1 << 19


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text: bit by bit the majority of its shingles' XXH64."""
    import xxhash

    text = W.words(texts, W.SPACED)
    count = text.lengths()
    # Words again with one space behind each, so that a shingle is one slice.
    sizes = np.diff(text.offsets)
    spaced = np.full(len(text.data) + len(sizes), 0x20, np.uint8)
    shift = np.repeat(np.arange(len(sizes)), sizes)
    spaced[np.arange(len(text.data)) + shift] = text.data
    begin = text.offsets[:-1] + np.arange(len(sizes))
    end = begin + sizes
    wide = np.minimum(count, shingle)
    shingles = np.where(count > 0, count - wide + 1, 0)
    first = W.ragged(text.first[:-1], shingles)
    last = first + np.repeat(wide, shingles) - 1
    raw = spaced.tobytes()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(begin[first].tolist(), end[last].tolist())),
        np.uint64,
        len(first),
    )
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(shingles)
    if not len(some):
        return out
    # Bits are counted eight at a time in the bytes of a word, over at most 255 hashes.
    starts = np.cumsum(shingles[some]) - shingles[some]
    parts = -(-shingles[some] // 255)
    cuts = np.repeat(starts, parts) + 255 * W.ragged(np.zeros(len(some), np.int64), parts)
    part_of = np.cumsum(parts) - parts
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(lanes, cuts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(sums, part_of, axis=0)
        major = (2 * ones > shingles[some][:, None]).astype(np.uint64)
        for lane in range(8):
            out[some] |= major[:, lane] << np.uint64(8 * lane + bit)
    return out


class SegmentCode:
    """Shortest way from a segment's word to the anchors near it."""

    def __init__(self, bits: int, threshold: int, parity: int = PARITY):
        length = (1 << parity) - 1
        # Column i of the parity check is i + 1; the bits beyond the code are kept as they are.
        column = [i + 1 if i < length else 0 for i in range(bits)]
        self.bits = bits
        self.column = np.array(column, np.int64)
        reach = RADIUS + threshold
        patterns = [(0, 0)]
        every = [(0, 0, -1)]
        for _ in range(reach):
            every = [
                (word | 1 << i, syndrome ^ column[i], i)
                for word, syndrome, last in every
                for i in range(last + 1, bits)
            ]
            patterns += [(word, syndrome) for word, syndrome, _ in every]
        # Flipping a pattern of the same syndrome leads to an anchor.
        by: list[list[int]] = [[] for _ in range(length + 1)]
        for word, syndrome in patterns:
            by[syndrome].append(word)
        self.flips = [np.array(x, np.int64) for x in by]
        self.counts = np.array([len(x) for x in by])
        self.flat = np.concatenate(self.flips)
        self.flat_at = np.cumsum(self.counts) - self.counts

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i, column in enumerate(self.column.tolist()):
            if column:
                out ^= ((words >> i) & 1) * column
        return out

    def home(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.syndrome(words)
        return np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words)

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All anchors within reach of each word, and how many each has."""
        syndrome = self.syndrome(words)
        counts = self.counts[syndrome]
        flips = self.flat[W.ragged(self.flat_at[syndrome], counts)]
        return np.repeat(words, counts) ^ flips, counts


def _dealt(segments, distance: int):
    """mapInArrow: each fingerprint at its home (role 0) and at all anchors near it (role 1)."""
    if sum(t + 1 for _, t in segments) <= distance or sum(b for b, _ in segments) != 64:
        raise ValueError("segments must hold 64 bits and miss no pair within the distance")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = [SegmentCode(bits, threshold) for bits, threshold in segments]
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(low, 4096).to_numpy().astype(np.int64)
                shift = 0
                for number, code in enumerate(codes):
                    word = (fp >> shift) & ((1 << code.bits) - 1)
                    shift += code.bits
                    near, counts = code.near(word)
                    key = np.concatenate([code.home(word), near]) | (number << 40)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key),
                            pa.array(np.repeat(np.int8([0, 1]), [len(fp), len(near)])),
                            pa.array(np.concatenate([fp, np.repeat(fp, counts)])),
                        ],
                        names=["anchor", "role", "fp"],
                    )

    return deal


def _forest(homes: np.ndarray, batch: np.ndarray, sets: DisjointSets, distance: int):
    """Links between ``batch`` and ``homes`` that connect all that is close; see ``sets`` there."""
    out = []
    for low in range(0, len(batch), 256):
        fps = batch[low : low + 256]
        near = np.bitwise_count(fps[:, None] ^ homes[None, :]) <= distance
        out += [(fps[row], homes[at]) for row, at in spanning_links(near, sets)]
    return out


def _compare(distance: int):
    """mapInArrow over rows sorted by (anchor, slot, role): links among what meets there."""

    def links_of(groups: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """All close pairs of small groups, expanded together."""
        homes = np.concatenate([h for h, _ in groups])
        copies = np.concatenate([c for _, c in groups])
        n_homes = np.array([len(h) for h, _ in groups])
        n_copies = np.array([len(c) for _, c in groups])
        each = np.repeat(n_homes, n_copies)
        right = W.ragged(np.repeat(np.cumsum(n_homes) - n_homes, n_copies), each)
        a, b = np.repeat(copies, each), homes[right]
        keep = (a < b) & (np.bitwise_count(a ^ b) <= distance)
        return np.stack([a[keep], b[keep]], axis=1)

    def batch_of(pairs: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(pairs.reshape(-1, 2), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))],
            names=["a", "b"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: list = []
        weight = 0
        current = None
        homes: list = []
        copies: list = []
        held = 0
        sets = None
        home_fps = np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            role = batch.column(2).to_numpy()
            fps = batch.column(3).to_numpy().astype(np.int64).view(np.uint64)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
                here = (int(key[low, 0]), int(key[low, 1]))
                if here != current:
                    # The group before is complete.
                    if sets is not None:
                        for lot in _flushed(home_fps, copies, sets, distance):
                            yield batch_of(lot)
                    elif homes and copies:
                        small.append((np.concatenate(homes), np.concatenate(copies)))
                        weight += len(small[-1][0]) * len(small[-1][1])
                    if weight >= 1 << 20:
                        yield batch_of(links_of(small))
                        small, weight = [], 0
                    current, homes, copies, held, sets = here, [], [], 0, None
                split = low + int(np.searchsorted(role[low:high], 1))
                if split > low:
                    homes.append(fps[low:split])
                if high > split:
                    copies.append(fps[split:high])
                    held += high - split
                if sets is None and homes and held * sum(map(len, homes)) > 4096:
                    home_fps = np.concatenate(homes)
                    sets = DisjointSets(len(home_fps))
                if sets is not None and held >= 4096:
                    for lot in _flushed(home_fps, copies, sets, distance):
                        yield batch_of(lot)
                    copies, held = [], 0
        if sets is not None:
            for lot in _flushed(home_fps, copies, sets, distance):
                yield batch_of(lot)
        elif homes and copies:
            small.append((np.concatenate(homes), np.concatenate(copies)))
        if small:
            yield batch_of(links_of(small))
            small = []
        W.return_memory()

    return compare


def _flushed(homes, copies, sets, distance) -> Iterator[np.ndarray]:
    if copies:
        found = _forest(homes, np.concatenate(copies), sets, distance)
        if found:
            pairs = np.array(found, np.uint64)
            yield pairs[pairs[:, 0] != pairs[:, 1]]


def close_links(prints: DataFrame, distance: int = DISTANCE, segments=SEGMENTS) -> DataFrame:
    """Links (a, b) that connect all of ``prints`` (fp, distinct) within ``distance`` bits.

    Among the copies and homes of one anchor only links that join two sets are
    returned, so a dense group gives as many links as it has fingerprints, not
    as many as it has pairs.  An anchor with many homes is split into slots by a
    hash of the fingerprint; its copies go to every slot.
    """
    dealt = stored(
        prints.select("fp").mapInArrow(
            _dealt(segments, distance), "anchor bigint, role tinyint, fp bigint"
        ),
        "anchors",
    )
    slots = (
        dealt.where("role = 0")
        .groupBy("anchor")
        .agg(F.ceil(F.count("*") / F.lit(HELD)).alias("slots"))
    )
    # An anchor without a home has nothing to compare with.
    placed = dealt.join(slots, "anchor").withColumn(
        "slot",
        F.explode(
            F.when(F.col("role") == 0, F.array(F.pmod(F.xxhash64("fp"), F.col("slots"))))
            .otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1))
        ),
    )
    return (
        placed.select("anchor", "slot", "role", "fp")
        .repartition("anchor", "slot")
        .sortWithinPartitions("anchor", "slot", "role")
        .mapInArrow(_compare(distance), "a bigint, b bigint")
        .distinct()
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) of each row of ``docs`` (doc_id, text, mark)."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = pa.array(fingerprints(batch.column(1)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), prints], names=["doc_id", "mark", "fp"]
        )

    return docs.select("doc_id", "text", "mark").mapInArrow(
        W.per_chunk(hashed, HASHED_BYTES), "doc_id bigint, mark bigint, fp bigint"
    )


def _rooted(rows: DataFrame, distance: int, segments) -> DataFrame:
    """(fp, root): the class of each fingerprint of ``rows``, and the least one it is linked to."""
    prints = stored(rows.select("fp").distinct(), "prints")
    found = components(close_links(prints, distance, segments))
    return stored(
        prints.join(found, prints["fp"] == found["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )


def grouped(docs: DataFrame, distance: int = DISTANCE, segments=SEGMENTS) -> DataFrame:
    """Per row of ``docs``: doc_id, fp and component_id, the least doc_id reachable by links.

    Rows with one fingerprint are one class; classes within ``distance`` bits are
    linked.  A text without words has fingerprint 0 and is linked like any other.
    A null doc_id takes part but names no component: a component of null ids
    only has a null component_id.  Repeated rows stay.  An empty table gives none.
    """
    marked = docs.select("doc_id", "text", F.lit(0).cast("bigint").alias("mark"))
    rows = stored(fingerprinted(marked), "fingerprints")
    rooted = _rooted(rows, distance, segments)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = stored(rooted.join(least, "fp"), "classes")
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    names = stored(classes.join(named, "root").select("fp", "component_id"), "named")
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, distance: int = DISTANCE, segments=SEGMENTS) -> DataFrame:
    """The rows of ``docs`` that stay, columns as given: one of each group.

    It is the row with the least doc_id, null last; of rows that share that id
    the one with the least hash over all columns, of identical rows one.  Columns
    that hold maps are hashed as JSON.
    """
    columns = docs.columns
    mark = F.xxhash64(
        *[
            F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name]
            for f in docs.schema
        ]
    )
    rows = stored(
        fingerprinted(docs.select("doc_id", "text", mark.alias("mark"))), "fingerprints"
    )
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    per_class = rows.groupBy("fp").agg(F.min(rank).alias("first"))
    leaders = (
        _rooted(rows, distance, segments)
        .join(per_class, "fp")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_lead_id"), F.col("first.mark").alias("_lead_mark"))
    )
    leaders = stored(leaders, "leaders")
    kept = docs.join(
        leaders, docs["doc_id"].eqNullSafe(leaders["_lead_id"]) & (mark == leaders["_lead_mark"]),
        "left_semi",
    )
    copies = rows.join(
        leaders,
        rows["doc_id"].eqNullSafe(leaders["_lead_id"]) & (rows["mark"] == leaders["_lead_mark"]),
        "left_semi",
    )
    repeated = copies.groupBy("doc_id", "mark").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    name = "_mark"
    while name in columns:
        name += "_"
    return kept.withColumn(name, mark).dropDuplicates(["doc_id", name]).drop(name)
