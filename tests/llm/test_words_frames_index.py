"""Word splitting, block encoding and the FM-index against plain versions."""

from __future__ import annotations

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, tokens, words
from tillweave.llm import anchors, frames, token_files, toxicity
from tillweave.llm import words as W
from tillweave.llm.fm_index import FMIndex, WaveletTree, suffix_order
from tillweave.llm.forest import DisjointSets, spanning_links
from tillweave.llm.q03_tokens import default_tokenizer


def _split(texts, table):
    found = W.words(pa.array(texts, pa.string()), table)
    names = [w.decode() for w in found.dictionary.to_pylist()]
    return [[names[c] for c in found.codes[a:b]] for a, b in zip(found.first, found.first[1:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9 \t\n\x0b.,é中\x00'_"), max_size=30))))
def test_words_match_patterns(texts):
    assert _split(texts, W.PLAIN) == [words(t) for t in texts]
    assert _split(texts, W.SPACED) == [tokens(t) for t in texts]


def test_words_of_odd_texts_and_slices():
    assert _split(ODD_TEXTS, W.SPACED) == [tokens(t) for t in ODD_TEXTS]
    column = pa.array(ODD_TEXTS).slice(3, 4)
    found = W.words(column, W.PLAIN)
    assert found.lengths().tolist() == [len(words(t)) for t in ODD_TEXTS[3:7]]


def test_chunks_keep_rows_in_order():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(ODD_TEXTS))), pa.array(ODD_TEXTS)], names=["id", "text"]
    )
    out = list(W.chunks([batch], size=1000))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(len(ODD_TEXTS)))
    assert len(out) > 2


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=700),
    st.integers(0, 700),
    st.integers(0, 700),
)
def test_blocks_round_trip(values, a, b):
    raw = np.array(values, np.uint32)
    data, starts = frames.encode(raw)
    assert frames.decode(data, starts).tolist() == values
    first, last = sorted((min(a, len(values)), min(b, len(values))))
    assert frames.read_range(data, starts, first, last).tolist() == values[first:last]


def test_blocks_patch_outliers():
    values = np.full(128, 7, np.uint32)
    values[5] = 2**31
    data, _ = frames.encode(values)
    assert len(data) == 8 + 5  # no packed bits, one exception


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=8))
def test_fm_index_finds_all(runs):
    sequence = np.array([x for run in runs for x in [*run, 0]], np.int64)
    order = suffix_order(sequence)
    assert sorted(order.tolist()) == list(range(len(sequence)))
    tree = WaveletTree(sequence, 5)
    at = np.arange(len(sequence))
    assert tree.access(at).tolist() == sequence.tolist()
    for symbol in range(5):
        want = [int((sequence[:i] == symbol).sum()) for i in at]
        assert tree.rank(np.full(len(at), symbol), at).tolist() == want
    index = FMIndex(sequence, 5, sample=3)
    for size in (1, 2, 3):
        phrases = np.array(
            [[1 + (i // 4**k) % 4 for k in range(size)] for i in range(4**size)], np.int64
        )
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases.tolist(), low, high):
            want = [
                i
                for i in range(len(sequence) - size + 1)
                if sequence[i : i + size].tolist() == phrase
            ]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_spanning_links_connect_what_is_near():
    rng = np.random.default_rng(0)
    for _ in range(200):
        near = rng.random((rng.integers(1, 8), rng.integers(1, 8))) < 0.3
        n, m = near.shape
        links = spanning_links(near, DisjointSets(m))
        assert all(near[a, b] for a, b in links) and len(links) < n + m
        got, want = DisjointSets(n + m), DisjointSets(n + m)
        for a, b in links:
            got.join(a, n + b)
        for a, b in zip(*np.nonzero(near)):
            want.join(int(a), n + int(b))
        assert got.roots().tolist() == want.roots().tolist()


def test_a_worker_keeps_an_encoder_only_between_its_own_tasks():
    path = default_tokenizer()
    encoder = weakref.ref(token_files.piece_encoder(path))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"])], names=["text"])
    assert list(W.gathered([batch], keeps=path))
    gc.collect()
    assert encoder() is token_files.piece_encoder(path)
    # A task of another operator runs in the same worker.
    assert list(W.gathered([batch]))
    gc.collect()
    assert encoder() is None


def _most_held(step, texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    try:
        for chunk in W.gathered([batch], size=size):
            step(chunk.column(0))
        return tracemalloc.get_traced_memory()[1] >> 20
    finally:
        tracemalloc.stop()


def test_fingerprints_and_scores_hold_little_at_once():
    texts = [" ".join(f"w{(i * j) % 9973}" for j in range(200)) for i in range(8000)]
    assert _most_held(anchors.fingerprints, texts, anchors.HASHED_BYTES) < 40
    model = toxicity.Model({"idiot": 2.0}, (-3.0, 0.3, 0.3))
    scores = _most_held(lambda t: toxicity._scores(t, model), texts, toxicity.SCORED_BYTES)
    assert scores < 40
