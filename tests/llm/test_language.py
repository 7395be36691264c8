"""Language identification: counts against a plain loop, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import odd_docs
from tillweave.llm import language
from tillweave.llm.queries import QUERIES

_TOP = (1 << 64) - 1


def _bucket(run):
    held = 0
    for sign in run:
        held = held * language._MIX[1] + ((0 if sign == " " else ord(sign)) + 1) * language._MIX[0]
        held &= _TOP
        held ^= held >> 29
    return (held * language._MIX[2] & _TOP) >> (64 - language.DIMS.bit_length() + 1)


def _plain(text):
    counts = np.zeros(language.DIMS, np.int64)
    low = "".join(
        (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or ""
    )
    for word in re.findall("[^ ]+", low):
        for run in [*word, *(f" {word} "[i : i + n] for n in (2, 3) for i in range(len(word) + 3 - n))]:
            counts[_bucket(run)] += 1
    return counts


def test_counts_are_those_of_a_plain_loop():
    pick = random.Random(2)
    signs = list("abcXYZéÉßİ中Σ  .,\n\x000😀")
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 30))) for _ in range(600)]
    texts[7] = None
    seen = 0
    for start, counts, lettered in language.counts_of(pa.array(texts)):
        for i, row in enumerate(counts):
            text = texts[start + i]
            assert row.tolist() == _plain(text).tolist(), text
            assert lettered[i] == any(c.isalpha() for c in text or "")
            seen += 1
    assert seen == len(texts)


def test_clusters_cover_separate_directions():
    rng = np.random.default_rng(1)
    vectors = np.repeat(np.eye(3, 8, dtype=np.float32), 30, axis=0)
    vectors += 0.01 * rng.random(vectors.shape, dtype=np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    found = language.clustered(vectors, 4)
    assert np.max(vectors @ found.T, axis=1).min() > 0.99
    assert len(language.clustered(vectors[:1], 4)) == 1


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op11_language_id"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    test = [d for d in docs if d.lang and zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert test and all(rows[d.doc_id].held_out for d in test)
    right = [rows[d.doc_id].lang_pred == d.lang for d in test]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    learn = spark.createDataFrame(
        [(i, t, l) for i, (t, l) in enumerate([("the dog is here", "en"), ("der hund ist da", "de")] * 20)]
        + [(99, None, "en"), (98, "...", "xx"), (97, "no label", None)],
        "doc_id long, text string, lang string",
    )
    model = language.trained(learn)
    assert set(model.languages) == {"de", "en"}
    rows = language.predicted(docs, model).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].nearest is None and by_id[1].score == 0.0 and by_id[1].rejected
    assert by_id[7].nearest in {"de", "en"}
    some = spark.createDataFrame([(1, "the dog"), (2, "DER HUND!"), (3, "中文")], "doc_id int, text string")
    found = {r.doc_id: r for r in language.predicted(some, model).collect()}
    assert (found[1].nearest, found[2].nearest) == ("en", "de")
    # Further from every centroid than the texts that were learned from.
    assert found[3].rejected
    assert language.predicted(docs.limit(0), model).collect() == []
    nothing = language.trained(learn.limit(0))
    assert [r.nearest for r in language.predicted(some, nothing).collect()] == [None] * 3


def test_sample_is_bounded_and_keeps_small_languages(spark):
    rows = [(f"word{i} text", "hot") for i in range(3000)] + [("rare one", "rare"), ("rare two", "rare")]
    learned = spark.createDataFrame(rows, "text string, lang string")
    counts = {r.lang: r["count"] for r in language.sampled(learned, 100).groupBy("lang").count().collect()}
    assert counts["rare"] == 2 and 50 < counts["hot"] < 150


@pytest.mark.parametrize("texts", [[], [None], [""]])
def test_no_texts(texts):
    for _, counts, lettered in language.counts_of(pa.array(texts, pa.string())):
        assert not counts.any() and not lettered.any()
