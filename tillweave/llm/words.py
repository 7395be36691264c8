"""Words of whole Arrow text columns, found with array operations instead of a loop over rows.

A table of 256 entries sends every byte to itself, to its lower-case form or to
``GAP``, which separates words and is no byte of UTF-8.  UTF-8 keeps every byte of a multi-byte character at
0x80 or above, so splitting at ASCII bytes never cuts a character.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text handled at once; one longer text is handled alone.
CHUNK_BYTES = 8 << 20


GAP = 0xFF


def byte_table(separators: Iterable[int], lower: bool = True) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[0x41:0x5B] += 32
    table[list(separators)] = GAP
    return table


_SPACES = [0x20, *range(0x09, 0x0E)]
#: Words are runs of ``[^\x20\x09-\x0D]``.
SPACED = byte_table(_SPACES)
#: Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z and all beyond ASCII.
PLAIN = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


@dataclass
class Words:
    """``codes[first[i]:first[i + 1]]`` are the words of text i, as places in ``dictionary``."""

    codes: np.ndarray
    first: np.ndarray
    dictionary: pa.Array
    #: Bytes of all words without separators, and where each word starts in them.
    data: np.ndarray
    offsets: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.lengths())


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 places where its texts begin; null is empty."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def cut(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray, extra: np.ndarray | None = None) -> Words:
    """Runs of bytes that ``keep`` maps to other than ``GAP``; ``extra`` marks more places where one starts."""
    mapped = keep[data]
    inside = mapped != GAP
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    starts[heads] = inside[heads]
    if extra is not None:
        starts |= extra & inside
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | starts[1:]
    begin = np.flatnonzero(starts)
    # Where each run lands once separators are squeezed out.
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(np.flatnonzero(stops) + 1 - begin, out=offsets[1:])
    compact = np.ascontiguousarray(mapped[inside])
    array = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(compact)]
    )
    coded = array.dictionary_encode()
    return Words(
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.searchsorted(begin, bounds),
        coded.dictionary,
        compact,
        offsets,
    )


def words(texts: pa.Array, keep: np.ndarray) -> Words:
    return cut(*raw_bytes(texts), keep)


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches again, cut so that each holds about ``size`` bytes of text, or one text."""
    for batch in batches:
        _, bounds = raw_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(bounds, bounds[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


#: What this worker process keeps from one task to the next.
_KEPT: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once and kept by this worker; tasks that use it name it to ``gathered``."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def drop_kept(but: str | None = None) -> None:
    """Forget what tasks of another operator have kept: its worker is now this one's."""
    others = [name for name in _KEPT if name != but]
    for name in others:
        del _KEPT[name]
    if others:
        return_memory()


def gathered(
    batches: Iterable[pa.RecordBatch],
    column: str = "text",
    size: int = CHUNK_BYTES,
    keeps: str | None = None,
) -> Iterator[pa.RecordBatch]:
    """Small batches joined and large ones cut, each about ``size`` bytes of text.

    Of what this worker has ``kept``, only ``keeps`` stays.
    """
    drop_kept(keeps)
    held: list[pa.RecordBatch] = []
    taken = 0
    for batch in chunks(batches, column, size):
        held.append(batch)
        taken += batch.column(batch.schema.get_field_index(column)).nbytes
        if taken >= size:
            yield _joined(held)
            held, taken = [], 0
    if held:
        yield _joined(held)
        held = []
    return_memory()


def return_memory() -> None:
    """Give freed memory back to the system: a worker outlives its task and is used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    whole = pa.Table.from_batches(held).combine_chunks()
    return whole.to_batches()[0] if whole.num_rows else held[0]


def per_chunk(
    step: Callable[[pa.RecordBatch], pa.RecordBatch], size: int = CHUNK_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that applies ``step`` to chunks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, size=size):
            yield step(batch)

    return run


def rows_where(
    docs: DataFrame,
    keep: Callable[[pa.Array], np.ndarray],
    column: str = "text",
    size: int = CHUNK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` whose text ``keep`` says True of; all columns as given, no join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, column, size):
            texts = batch.column(batch.schema.get_field_index(column))
            yield batch.filter(pa.array(keep(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def ragged(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``first[i], first[i] + 1, ...`` for each i, one after another."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(first, lengths)
