"""Alignment of two tokenizers against whole-text tokenization and set intersection."""

from __future__ import annotations

import bisect
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import odd_docs
from tillweave.llm import alignment
from tillweave.llm.q12_alignment import default_pair, sha256
from tillweave.llm.queries import QUERIES


@pytest.fixture(scope="module")
def both():
    return _Plain(*default_pair())


class _Plain:
    """Whole texts through both tokenizers; groups between all ends that both share."""

    def __init__(self, byte_level, pieces):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)

    def _bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        whole = (" " + text).encode()
        coded = self.a.encode(" " + text, add_special_tokens=False)
        table = alignment._visible_alphabet()
        a = [(i, bytes(table[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
        b = [(i, self._bytes_b(i)) for i in self.b.encode(text)]
        if any(b"".join(x for _, x in side) != whole for side in (a, b)):
            return []
        ends = []
        for side in (a, b):
            at, mine = 0, []
            for _, x in side:
                at += len(x)
                mine.append(at)
            ends.append(mine)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        sides = []
        for side, es in ((a, ends[0]), (b, ends[1])):
            mine = [[] for _ in cuts]
            for (i, _), end in zip(side, es):
                mine[bisect.bisect_left(cuts, end)].append(i)
            sides.append(mine)
        return list(zip(*sides))


def _written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def _want(both, rows):
    found = [(r.doc_id, both.groups(r.text)) for r in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
    counts = Counter(pair for link in links for pair in link)
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    return [
        (
            doc_id,
            sum(len(a) for a, _ in g),
            sum(len(b) for _, b in g),
            len(g),
            sum(link.values()),
            sum(n for p, n in link.items() if counts[p] == top[p[0]]),
            sum(n * counts[p] for p, n in link.items()),
            sha256(_written(g)) if g else "",
        )
        for (doc_id, g), link in zip(found, links)
    ]


def test_alignment_of_sample(spark, sf_dir, both):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = QUERIES["op12_token_alignment"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(_want(both, rows))
    assert any(r.n_groups < min(r.n_a, r.n_b) for r in got)


def test_alignment_of_odd_texts(spark, both, monkeypatch):
    docs = odd_docs(spark)
    rows = docs.collect()
    got = alignment.aligned(docs, *default_pair(), of_groups=sha256).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, _want(both, rows)))
    assert alignment.aligned(docs.limit(0), *default_pair()).collect() == []
    # Groups themselves, and texts of which one tokenizer does not give the bytes back.
    some = spark.createDataFrame([(1, "some words"), (2, "a ▁ b"), (3, "some")], "doc_id int, text string")
    texts = {r.doc_id: r for r in alignment.aligned(some, *default_pair()).collect()}
    assert texts[1].groups == _written(both.groups("some words"))
    assert texts[2].n_a == 0 and texts[2].groups == ""


def test_stretches_change_nothing(both):
    signs = list("abXY019 .,'\n\t ́éÉßΣ’中😀  　\u0085\u001c") + [" ", "  ", "'s", "<|endoftext|>", "\x00"]
    pick = random.Random(5)
    some = ["".join(pick.choice(signs) for _ in range(pick.randint(1, 30))) for _ in range(3000)]
    made = alignment.Aligner(*default_pair()).lot(pa.array(some), str)
    for text, groups in zip(some, made["groups"]):
        assert groups == _written(both.groups(text)), repr(text)


def test_dividing_finds_every_common_end():
    pick = random.Random(9)
    for _ in range(300):
        ends_a, ends_b, bounds_a, bounds_b, want, base = [], [], [0], [0], [], 0
        for _ in range(pick.randint(0, 4)):
            size = pick.randint(1, 60)
            a, b = (
                sorted({*pick.sample(range(1, size + 1), pick.randint(1, size)), size})
                for _ in range(2)
            )
            ends_a += [base + x for x in a]
            ends_b += [base + x for x in b]
            bounds_a.append(len(ends_a))
            bounds_b.append(len(ends_b))
            want += [base + x for x in sorted(set(a) & set(b))]
            base += size
        ends_a, ends_b = np.array(ends_a, np.int64), np.array(ends_b, np.int64)
        a0, a1, b0, b1 = alignment.divided(ends_a, ends_b, np.array(bounds_a), np.array(bounds_b))
        assert ends_a[a1 - 1].tolist() == want == ends_b[b1 - 1].tolist()
        assert a0.tolist() == [0, *a1.tolist()][: len(a0)] and b0.tolist() == [0, *b1.tolist()][: len(b0)]


def test_runs_and_wide_groups_change_nothing(spark, sf_dir, monkeypatch):
    made = alignment.Aligner(*default_pair())
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20).collect()
    texts = pa.array([r.text for r in rows])
    want = {k: np.asarray(v).tolist() for k, v in made.lot(texts, sha256).items()}
    monkeypatch.setattr(alignment, "RUN_BYTES", 1)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    assert {k: np.asarray(v).tolist() for k, v in made.lot(texts, sha256).items()} == want
