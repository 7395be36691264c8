"""Alignment of the tokens that two tokenizers make of the same text.

Both token sequences cover the same bytes.  Where a token of either ends at the
same byte they can be cut; between two cuts lies a group, and the tokens of a
group are linked with each other.  An interval is divided at the common end
nearest its middle, which is looked up by bisection, then both halves; an
interval without a common end within is a group.

Neither tokenizer has a token that goes on from a letter into a space, so a text
is cut there first, and each distinct stretch of a lot of texts is encoded and
divided once.  A lot lists its distinct pairs of linked ids with the number of
its documents that hold them.  Those rows alone are shuffled to count pairs over
the corpus, and the counts come back by lot.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.tables import stored

#: Bytes of text in a lot; one longer text is a lot alone.
LOT_BYTES = 1 << 20
#: Bytes of distinct stretches that are encoded as one text.
RUN_BYTES = 1 << 14
#: Runs that are encoded in one call; what the tokenizers hold for them is many times their text.
CALL_RUNS = 8
#: Links of a group beyond which they are counted by distinct ids.
WIDE_GROUP = 1 << 12

_LOT_SCHEMA = (
    "lot bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,"
    " n_links array<bigint>, groups array<string>, pairs array<bigint>, holders array<bigint>,"
    " held array<bigint>, codes binary, more binary, times binary"
)
#: A pair is one number: the id of the first tokenizer above this bit, the second's below.
_ID_BITS = 32

_AS_IS = np.arange(256, dtype=np.uint8)
# Signs after which a space begins a new stretch: printable ASCII, and letters of two
# bytes, whose lead bytes these are.  After white space the first tokenizer looks further.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEADS = np.zeros(256, bool)
_LEADS[[0xC3, 0xC4, 0xC5, 0xCE, 0xCF, 0xD0, 0xD1]] = True


def divided(
    ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of two token sequences over the same bytes, in order: ranges ``a0, a1, b0, b1``.

    ``ends_a`` and ``ends_b`` are the ascending ends of tokens of a byte at
    least; the bounds are the places of the first tokens of each stretch, and the
    number of tokens.  All intervals of a depth are divided at once.
    """
    a0, a1, b0, b1 = bounds_a[:-1], bounds_a[1:], bounds_b[:-1], bounds_b[1:]
    filled = a1 > a0
    open_ = [x[filled] for x in (a0, a1, b0, b1)]
    closed = []
    while len(open_[0]):
        a0, a1, b0, b1 = open_
        alone = (a1 - a0 == 1) | (b1 - b0 == 1)
        closed.append([x[alone] for x in open_])
        a0, a1, b0, b1 = (x[~alone] for x in open_)
        cut_a, cut_b = _middle_cuts(ends_a, ends_b, a0, a1)
        cut = cut_a > 0
        closed.append([x[~cut] for x in (a0, a1, b0, b1)])
        a0, a1, b0, b1, cut_a, cut_b = (x[cut] for x in (a0, a1, b0, b1, cut_a, cut_b))
        open_ = [
            np.concatenate(x) for x in ((a0, cut_a), (cut_a, a1), (b0, cut_b), (cut_b, b1))
        ]
    if not closed:
        return (np.zeros(0, np.int64),) * 4
    groups = [np.concatenate(x) for x in zip(*closed)]
    order = np.argsort(groups[0])
    return tuple(x[order] for x in groups)


def _middle_cuts(ends_a, ends_b, a0, a1) -> tuple[np.ndarray, np.ndarray]:
    """Per interval the places in both sequences after the common end nearest its middle, or 0."""
    cut_a, cut_b = np.zeros((2, len(a0)), np.int64)
    if not len(a0):
        return cut_a, cut_b
    begin = np.where(a0 > 0, ends_a[a0 - 1], 0)
    middle = np.searchsorted(ends_a, (begin + ends_a[a1 - 1]) // 2)
    # The interval's own end is no cut.
    last = a1 - 2
    middle = np.clip(middle, a0, last)
    waiting, step = np.arange(len(a0)), 0
    while len(waiting):
        for side in (1, -1):
            place = middle[waiting] + side * step
            place = np.clip(place, a0[waiting], last[waiting])
            end = ends_a[place]
            found = np.searchsorted(ends_b, end)
            hit = ends_b[found] == end
            cut_a[waiting[hit]] = place[hit] + 1
            cut_b[waiting[hit]] = found[hit] + 1
            waiting = waiting[~hit]
        step += 1
        left = middle[waiting] - step >= a0[waiting]
        waiting = waiting[left | (middle[waiting] + step <= last[waiting])]
    return cut_a, cut_b


def _visible_alphabet() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Encodes texts with both tokenizers and divides them into groups."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        # Special tokens' strings within a text are plain text.
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = _visible_alphabet()
        self.bytes_a = [b""] * self.first.get_vocab_size()
        for token, i in self.first.get_vocab(with_added_tokens=False).items():
            if any(c not in alphabet for c in token):
                raise ValueError(f"{byte_level} is not byte-level: {token!r}")
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.bytes_b = [b""] * self.second.get_piece_size()
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            if self.second.is_byte(i):
                self.bytes_b[i] = bytes([int(piece[3:5], 16)])
                continue
            if " " in piece.replace("▁", " ").lstrip(" "):
                raise ValueError(f"a piece goes on behind a space: {piece!r}")
            self.bytes_b[i] = piece.replace("▁", " ").encode()
        self.size_a, self.size_b = (np.array([len(x) for x in of]) for of in (self.bytes_a, self.bytes_b))
        top = max(len(self.bytes_a), len(self.bytes_b))
        written = [b"%d" % i for i in range(top)]
        self.digits = np.array([len(w) for w in written])
        #: Each id's digits and room for the sign behind them.
        wide = int(self.digits.max()) + 1
        self.signs = np.frombuffer(b"".join(w.ljust(wide) for w in written), np.uint8).reshape(top, wide)

    def _runs(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
        """Stretches in runs that can be encoded as one text without changing a token."""
        ends = bounds[1:]
        joins = _VISIBLE[data[ends - 1]] | ((data[ends - 1] >= 0x80) & _LEADS[data[ends - 2]])
        runs, start = [], 0
        for i in range(len(ends)):
            if not joins[i] or ends[i] - bounds[start] >= RUN_BYTES:
                runs.append((start, i + 1))
                start = i + 1
        if start < len(ends):
            runs.append((start, len(ends)))
        return runs

    def _tokens(self, data: np.ndarray, bounds: np.ndarray) -> tuple[list, list, np.ndarray]:
        """Ids of both tokenizers, one array per run, and which stretches they do not give back."""
        bad = np.zeros(len(bounds) - 1, bool)
        out_a, out_b = [], []
        whole = data.tobytes()

        def encode(runs: list[tuple[int, int]]) -> None:
            raw = [whole[bounds[i] : bounds[j]] for i, j in runs]
            texts = [r.decode("utf-8") for r in raw]
            coded = self.first.encode_batch_fast(texts, add_special_tokens=False)
            # Every run begins with a space, which the second tokenizer adds by itself.
            pieces = self.second.encode([t[1:] for t in texts], num_threads=1)
            for (i, j), was, first, b in zip(runs, raw, coded, pieces):
                a = first.ids
                if (
                    b"".join(map(self.bytes_a.__getitem__, a)) == was
                    and b"".join(map(self.bytes_b.__getitem__, b)) == was
                ):
                    out_a.append(np.array(a, np.int32))
                    out_b.append(np.array(b, np.int32))
                elif j - i > 1:
                    encode_all([(k, k + 1) for k in range(i, j)])
                else:
                    bad[i] = True

        def encode_all(runs: list[tuple[int, int]]) -> None:
            for at in range(0, len(runs), CALL_RUNS):
                encode(runs[at : at + CALL_RUNS])

        encode_all(self._runs(data, bounds))
        return out_a, out_b, bad

    def lot(self, texts: pa.Array, of_groups: Callable[[str], str]) -> dict[str, object]:
        """Counts per text, distinct pairs of the lot, and the pairs of each text."""
        count = len(texts)
        filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
        space, nothing = (pa.scalar(x, pa.large_binary()) for x in (b" ", b""))
        spaced = pc.binary_join_element_wise(space, texts.cast(pa.large_binary()), nothing)
        data, bounds = W.raw_bytes(pc.if_else(filled, spaced, pa.scalar(None, pa.large_binary())))
        cut = W.cut(data, bounds, _AS_IS, _stretch_starts(data, bounds))
        if not len(cut.dictionary):
            zeros, empty = np.zeros(count, np.int64), np.zeros(0, np.int64)
            return _lot([zeros] * 4, [""] * count, empty, empty, zeros, empty, empty)
        owner = cut.owner()
        made = self._stretches(*W.raw_bytes(cut.dictionary))
        lost = np.bincount(owner, made.bad[cut.codes], minlength=count) > 0
        sums = [
            np.where(lost, 0, np.bincount(owner, of[cut.codes], minlength=count)).astype(np.int64)
            for of in (made.n_a, made.n_b, made.n_groups, made.n_links)
        ]
        groups = []
        for i in range(count):
            mine = cut.codes[cut.first[i] : cut.first[i + 1]]
            if lost[i] or not len(mine):
                groups.append("")
            else:
                groups.append(of_groups(b";".join([made.written[c] for c in mine.tolist()]).decode()))
        # Each distinct stretch of a text once, with how often it occurs there.
        good = ~lost[owner]
        stretches = len(made.bad)
        both, often = np.unique(owner[good] * stretches + cut.codes[good], return_counts=True)
        text, stretch = np.divmod(both, stretches)
        sizes = np.diff(made.first)[stretch]
        at = W.ragged(made.first[stretch], sizes)
        pairs = len(made.pairs)
        links, place = np.unique(np.repeat(text, sizes) * pairs + made.codes[at], return_inverse=True)
        times = np.bincount(place, np.repeat(often, sizes) * made.times[at], minlength=len(links))
        text, code = np.divmod(links, max(pairs, 1))
        holders = np.bincount(code, minlength=pairs)
        held = np.bincount(text, minlength=count)
        return _lot(sums, groups, made.pairs, holders, held, code, times.astype(np.int64))

    def _stretches(self, data: np.ndarray, bounds: np.ndarray) -> _Stretches:
        out_a, out_b, bad = self._tokens(data, bounds)
        ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (out_a, out_b))
        # Ends of tokens, counting the bytes of good stretches alone.
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        stops = np.cumsum(np.where(bad, 0, np.diff(bounds)))
        bounds_a, bounds_b = (
            np.append(0, np.searchsorted(ends, stops, side="right")) for ends in (ends_a, ends_b)
        )
        a0, a1, b0, b1 = divided(ends_a, ends_b, bounds_a, bounds_b)
        of = np.searchsorted(bounds_a, a0, side="right") - 1
        stretch, keys, times = _linked(ids_a, ids_b, a0, a1, b0, b1, of)
        pairs, codes = np.unique(keys, return_inverse=True)
        both, place = np.unique(stretch * max(len(pairs), 1) + codes, return_inverse=True)
        times = np.bincount(place, times, minlength=len(both)).astype(np.int64)
        stretch, codes = np.divmod(both, max(len(pairs), 1))
        n = len(bad)
        return _Stretches(
            bad,
            np.diff(bounds_a),
            np.diff(bounds_b),
            np.bincount(of, minlength=n),
            np.bincount(of, (a1 - a0) * (b1 - b0), minlength=n),
            self._written(ids_a, ids_b, a0, a1, b0, b1, bounds_a + bounds_b),
            np.searchsorted(stretch, np.arange(n + 1)),
            pairs,
            codes,
            times,
        )

    def _written(self, ids_a, ids_b, a0, a1, b0, b1, bounds) -> list[bytes]:
        """Each stretch's groups as ``a1,a2|b1;a3|b2``: digits of all tokens in their order, and signs."""
        tokens = len(ids_a) + len(ids_b)
        ids = np.zeros(tokens, np.int64)
        signs = np.full(tokens, ord(","), np.uint8)
        # Before a group's tokens of one side stand all earlier ones of the other.
        ids[np.arange(len(ids_a)) + np.repeat(b0, a1 - a0)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(a1, b1 - b0)] = ids_b
        signs[a1 - 1 + b0] = ord("|")
        signs[b1 - 1 + a1] = ord(";")
        rows = self.signs[ids]
        wide = self.digits[ids]
        rows[np.arange(tokens), wide] = signs
        flat = rows[np.arange(rows.shape[1]) <= wide[:, None]].tobytes()
        at = np.append(0, np.cumsum(wide + 1))[bounds].tolist()
        return [flat[i : max(j - 1, i)] for i, j in zip(at, at[1:])]


@dataclass
class _Stretches:
    """What is known of each distinct stretch of a lot."""

    bad: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    written: list[bytes]
    #: ``codes[first[i]:first[i + 1]]`` are the places of stretch i's distinct links in ``pairs``.
    first: np.ndarray
    pairs: np.ndarray
    codes: np.ndarray
    times: np.ndarray


def _linked(ids_a, ids_b, a0, a1, b0, b1, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every link's stretch and pair, and how many links it stands for."""
    n_a, n_b = a1 - a0, b1 - b0
    small = n_a * n_b <= WIDE_GROUP
    sizes = (n_a * n_b)[small]
    group = np.repeat(np.flatnonzero(small), sizes)
    within = W.ragged(np.zeros(len(sizes), np.int64), sizes)
    x, y = np.divmod(within, n_b[group])
    stretch = [of[group]]
    keys = [ids_a[a0[group] + x] << _ID_BITS | ids_b[b0[group] + y]]
    times = [np.ones(len(group), np.int64)]
    # The links of a group of many tokens from its distinct ids.
    for g in np.flatnonzero(~small):
        own_a, many_a = np.unique(ids_a[a0[g] : a1[g]], return_counts=True)
        own_b, many_b = np.unique(ids_b[b0[g] : b1[g]], return_counts=True)
        keys.append((own_a[:, None] << _ID_BITS | own_b).ravel())
        times.append((many_a[:, None] * many_b).ravel())
        stretch.append(np.full(len(keys[-1]), of[g]))
    return tuple(np.concatenate(x) for x in (stretch, keys, times))


def _lot(sums, groups, pairs, holders, held, codes, times) -> dict[str, object]:
    # A pair of which only texts without tokens would hold occurrences is none.
    kept = holders > 0
    new = np.cumsum(kept) - 1
    return {
        "n_a": sums[0],
        "n_b": sums[1],
        "n_groups": sums[2],
        "n_links": sums[3],
        "groups": groups,
        "pairs": pairs[kept],
        "holders": holders[kept],
        "held": held,
        "codes": new[codes].astype("<u4").tobytes(),
        # Most pairs occur once in a text; the others' places and numbers.
        "more": np.flatnonzero(times > 1).astype("<u4").tobytes(),
        "times": times[times > 1].astype("<u4").tobytes(),
    }


def _stretch_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Spaces before which a text can be cut; never its first or last byte."""
    starts = np.zeros(len(data), bool)
    if len(data) > 2:
        before = _VISIBLE[data[1:-1]]
        before |= (data[1:-1] >= 0x80) & _LEADS[data[:-2]]
        starts[2:] = (data[2:] == 0x20) & before
        starts[bounds[1:][bounds[1:] > 0] - 1] = False
    return starts


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, pieces: str) -> Aligner:
    """One aligner per worker process and pair of tokenizers."""
    if (byte_level, pieces) not in _ALIGNERS:
        _ALIGNERS[byte_level, pieces] = Aligner(byte_level, pieces)
    return _ALIGNERS[byte_level, pieces]


def lots(
    docs: DataFrame, byte_level: str, pieces: str, of_groups: Callable[[str], str] = str
) -> DataFrame:
    """One row per lot of documents, see ``aligned``; stored, as lots are numbered by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_both = aligner(byte_level, pieces)
        task, number = TaskContext.get().partitionId(), 0
        for batch in W.gathered(batches, size=LOT_BYTES):
            made = with_both.lot(batch.column(1), of_groups)
            row = {"lot": task << _ID_BITS | number, "doc_ids": batch.column(0).to_pylist(), **made}
            number += 1
            made = None
            out = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row.values(), _LOT_TYPES.values())],
                names=list(_LOT_TYPES),
            )
            row = None
            W.return_memory()
            yield out

    return stored(docs.select("doc_id", "text").mapInArrow(run, _LOT_SCHEMA), "aligned-lots")


_LONGS = pa.list_(pa.int64())
_LOT_TYPES = {
    "lot": pa.int64(),
    "doc_ids": _LONGS,
    "n_a": _LONGS,
    "n_b": _LONGS,
    "n_groups": _LONGS,
    "n_links": _LONGS,
    "groups": pa.list_(pa.string()),
    "pairs": _LONGS,
    "holders": _LONGS,
    "held": _LONGS,
    "codes": pa.binary(),
    "more": pa.binary(),
    "times": pa.binary(),
}


def pair_counts(lots_of: DataFrame) -> DataFrame:
    """Per pair of linked ids: pair, a, b, count of documents that hold it, and is_best.

    ``is_best`` holds if no other pair of the same first id has a larger count.
    An id is linked with at most as many others as the second vocabulary has.
    """
    counts = (
        lots_of.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.holders").alias("count"))
        .withColumn("a", F.shiftright("pair", _ID_BITS))
        .withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)))
    )
    return counts.withColumn(
        "is_best", F.col("count") == F.max("count").over(Window.partitionBy("a"))
    )


def aligned(
    docs: DataFrame, byte_level: str, pieces: str, of_groups: Callable[[str], str] = str
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): how its tokens align, and how common its links are.

    ``byte_level`` is a tokenizers file, ``pieces`` a sentencepiece model that
    puts a space before a text; the first is given the space as well.  Columns:
    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.  ``groups``
    is ``of_groups`` of the groups written as ``a1,a2|b1;a3|b2,b3``.  A link's
    count is the number of documents that hold its pair of ids linked.

    A text that is null or empty, or whose bytes one of the tokenizers does not
    give back, has no tokens: zeros, and an empty ``groups``.  Ids that are null
    or repeat stay rows of their own, and each counts as a document.  An empty
    table gives an empty result.  Other columns are not looked at.
    """
    rows = lots(docs, byte_level, pieces, of_groups)
    each = rows.select("lot", F.posexplode("pairs").alias("pos", "pair"))
    counts = pair_counts(rows).select("pair", "count", "is_best")
    by_lot = (
        each.join(counts, "pair")
        .groupBy("lot")
        # As many as a lot has distinct pairs, which its bytes bound.
        .agg(F.collect_list(F.struct("pos", "count", "is_best")).alias("known"))
    )
    met = rows.drop("pairs", "holders").join(by_lot, "lot", "left").drop("lot")
    return met.mapInArrow(
        _per_document,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
        " n_best bigint, count_sum bigint, groups string",
    )


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            held = row["held"].values.to_numpy()
            codes, more, often = (
                np.frombuffer(row[c].as_buffer(), "<u4") for c in ("codes", "more", "times")
            )
            times = np.ones(len(codes), np.int64)
            times[more] = often
            best, total = np.zeros((2, len(held)), np.int64)
            if row["known"].is_valid:
                known = row["known"].values
                place, count, is_best = (known.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                counts = np.zeros(len(place), np.int64)
                counts[place] = count
                tops = np.zeros(len(place), bool)
                tops[place] = is_best
                # Sums by running totals: exact, whatever the counts.
                ends = np.append(0, np.cumsum(held))
                total = np.diff(np.append(0, np.cumsum(times * counts[codes]))[ends])
                best = np.diff(np.append(0, np.cumsum(times * tops[codes]))[ends])
            yield pa.RecordBatch.from_arrays(
                [
                    row["doc_ids"].values,
                    *[row[c].values for c in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(best),
                    pa.array(total),
                    row["groups"].values,
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )
