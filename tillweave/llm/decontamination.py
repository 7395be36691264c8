"""Benchmark decontamination with an FM-index per shard of the training text.

The windows of the benchmark are searched backward in the index of each shard;
their occurrences are located through sampled suffix places and merged into
spans to remove.  A shard is a bounded amount of text within one task.  Its
index holds the runs of words that the benchmark also has, at least as long as
the shortest window: no other run can hold an occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.fm_index import FMIndex
from tillweave.llm.licence_automaton import known_runs, split_words

#: Bytes of benchmark text that one pass over the documents searches for.
PASS_BYTES = 16 << 20

FOUND_SCHEMA = (
    "doc_id bigint, row bigint, n_words bigint, items array<string>,"
    " spans array<struct<first_word:bigint,end_word:bigint>>"
)


@dataclass
class Windows:
    """Distinct windows of benchmark items as word numbers, by length, with their items."""

    vocabulary: dict[bytes, int]
    by_size: dict[int, np.ndarray]
    items: dict[int, list[tuple[str, ...]]]

    @classmethod
    def of(cls, items: Sequence[tuple[str | None, str | None]], size: int) -> Windows:
        vocabulary: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], dict[str, None]] = {}
        for name, text in items:
            coded = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in split_words(text or "")]
            take = min(size, len(coded))
            for start in range(len(coded) - take + 1) if take else ():
                held = seen.setdefault(tuple(coded[start : start + take]), {})
                if name is not None:
                    held[name] = None
        by_size: dict[int, list] = {}
        names: dict[int, list] = {}
        for window, held in seen.items():
            by_size.setdefault(len(window), []).append(window)
            names.setdefault(len(window), []).append(tuple(held))
        return cls(vocabulary, {n: np.array(w, np.int64) for n, w in by_size.items()}, names)


def benchmark_passes(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items (id as text, text) in lots of ``PASS_BYTES``, however large the table is."""
    lot: list = []
    held = 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    for name, text in rows.toLocalIterator():
        lot.append((name, text))
        held += len(text or "")
        if held >= PASS_BYTES:
            yield lot
            lot, held = [], 0
    if lot:
        yield lot


def _search_chunk(windows: Windows, batch: pa.RecordBatch) -> pa.RecordBatch:
    text = W.words(batch.column(1), W.PLAIN)
    number = np.fromiter(
        (windows.vocabulary.get(w, 0) for w in text.dictionary.to_pylist()),
        np.int64,
        len(text.dictionary),
    )
    codes = number[text.codes] if len(number) else np.zeros(0, np.int64)
    runs = list(known_runs(codes > 0, text.first, min(windows.by_size, default=1)))
    count = batch.num_rows
    items: list[list[str]] = [[] for _ in range(count)]
    spans: list[list[dict]] = [[] for _ in range(count)]
    if runs and windows.by_size:
        owner, start, stop = (np.array(x, np.int64) for x in zip(*runs))
        place, hit_size, hit_items = _occurrences(windows, codes, start, stop)
        run = np.searchsorted(start, place, side="right") - 1
        doc = owner[run]
        change = np.zeros(len(codes) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + hit_size, -1)
        hit = np.cumsum(change[:-1]) > 0
        for d, a, b in known_runs(hit, text.first, 1):
            base = int(text.first[d])
            spans[d].append({"first_word": a - base, "end_word": b - base})
        for d, names in zip(doc.tolist(), hit_items):
            items[d].extend(names)
    span_type = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(2),
            pa.array(text.lengths(), pa.int64()),
            pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
            pa.array(spans, span_type),
        ],
        names=["doc_id", "row", "n_words", "items", "spans"],
    )


def _occurrences(
    windows: Windows, codes: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[tuple[str, ...]]]:
    """Word places of all occurrences in the runs, the windows' sizes and their items."""
    sizes = stop - start
    taken = W.ragged(start, sizes)
    # The runs one after another, each closed by a 0; ``origin`` leads back to the text.
    inner = np.arange(len(taken)) + np.repeat(np.arange(len(start)), sizes)
    sequence = np.zeros(len(taken) + len(start), np.int64)
    sequence[inner] = codes[taken]
    origin = np.zeros(len(sequence), np.int64)
    origin[inner] = taken
    # Only symbols that occur here, numbered anew in the same order.
    present = np.unique(sequence)
    index = FMIndex(np.searchsorted(present, sequence), len(present))
    places, widths, names = [], [], []
    for size, phrases in windows.by_size.items():
        local = np.searchsorted(present, phrases)
        there = (present[np.minimum(local, len(present) - 1)] == phrases).all(axis=1)
        which = np.flatnonzero(there)
        low, high = index.search(local[which])
        found = high - low
        rows = W.ragged(low, found)
        places.append(origin[index.locate(rows)])
        widths.append(np.full(len(rows), size, np.int64))
        of = np.repeat(which, found).tolist()
        names += [windows.items[size][w] for w in of]
    return np.concatenate(places), np.concatenate(widths), names


def searched(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, items with occurring windows, spans of words.

    A window is ``size`` consecutive words of an item, or all of a shorter one.
    A null or empty text has no words; an item without words has no window; an
    item whose id is null hits words but is not named.  Items that share an id
    count once.  Repeated documents are searched alike, each on its own.  An
    empty benchmark hits nothing.
    """
    lots = [Windows.of(items, size) for items in benchmark_passes(benchmark)]
    rows = docs.select("doc_id", "text")
    if len(lots) <= 1:
        return _one_pass(rows.withColumn("row", F.lit(0).cast("bigint")), lots).drop("row")
    # Every lot searches all documents; what they find for a row is joined again.
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    found = _one_pass(numbered, lots[:1])
    for lot in lots[1:]:
        found = found.unionByName(_one_pass(numbered, [lot]))
    return found.groupBy("doc_id", "row", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        merged_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
    ).drop("row")


def _one_pass(rows: DataFrame, lots: list[Windows]) -> DataFrame:
    windows = lots[0] if lots else Windows({}, {}, {})
    shared = rows.sparkSession.sparkContext.broadcast(windows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches):
            yield _search_chunk(shared.value, batch)

    return rows.mapInArrow(search, FOUND_SCHEMA)


def merged_spans(spans):
    """Spans of several lots, sorted and joined where they touch."""
    empty = F.array().cast("array<struct<first_word:bigint,end_word:bigint>>")

    def grow(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["first_word"] <= last["end_word"])
        longer = F.struct(
            last["first_word"].alias("first_word"),
            F.greatest(last["end_word"], span["end_word"]).alias("end_word"),
        )
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, grow)


def hit_words(spans):
    return F.aggregate(
        spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end_word"] - s["first_word"]
    )


def items_digest(names: Sequence[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def uncontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, columns as given.

    Every lot of the benchmark looks at what the lots before it left.
    """
    context = docs.sparkSession.sparkContext
    for items in benchmark_passes(benchmark):
        shared = context.broadcast(Windows.of(items, size))

        def clean(texts: pa.Array, shared=shared) -> np.ndarray:
            none = pa.nulls(len(texts), pa.int64())
            rows = pa.RecordBatch.from_arrays([none, texts, none], names=["doc_id", "text", "row"])
            return np.array([not s for s in _search_chunk(shared.value, rows).column(4).to_pylist()])

        docs = W.rows_where(docs, clean)
    return docs


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` with the words of every occurrence cut from the texts; n_chars is kept as it was.

    A word is cut with what stands between it and the next word.
    """
    context = docs.sparkSession.sparkContext
    place = docs.columns.index("text")
    for items in benchmark_passes(benchmark):
        shared = context.broadcast(Windows.of(items, size))

        def cut(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in W.gathered(batches):
                texts = batch.column(place)
                none = pa.nulls(len(texts), pa.int64())
                rows = pa.RecordBatch.from_arrays([none, texts, none], names=["doc_id", "text", "row"])
                spans = _search_chunk(shared.value, rows).column(4).to_pylist()
                fresh = pa.array(
                    [_cut(t, s) if s else t for t, s in zip(texts.to_pylist(), spans)], pa.string()
                )
                yield batch.set_column(place, batch.schema.field(place), fresh)

        docs = docs.mapInArrow(cut, docs.schema)
    return docs


def _cut(text: str, spans: list[dict]) -> str:
    raw = text.encode("utf-8")
    inside = W.PLAIN[np.frombuffer(raw, np.uint8)] != W.GAP
    starts = np.flatnonzero(inside & ~np.append(False, inside[:-1])).tolist() + [len(raw)]
    out, at = [], 0
    for span in spans:
        out.append(raw[at : starts[span["first_word"]]])
        at = starts[span["end_word"]]
    return b"".join([*out, raw[at:]]).decode("utf-8")
