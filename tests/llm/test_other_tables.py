"""Operators over pages, embeddings and conversations, and the pipeline."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import components
from tillweave.llm import product_quantiser, quotations, url_vocabulary
from tillweave.llm.queries import QUERIES
from tillweave.session import scratch_path

# --- urls ------------------------------------------------------------------------------------


def _judged(spark, urls, **how):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    return {r.page_id: r for r in url_vocabulary.judged(pages, **how).collect()}


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme/casino", "HTTP://WWW.Example.ORG/es/x?q#f", "http://example.org/en/12",
        "http://example.org", "https://a.com/de/1", "https://a.com/fr/casino", "x://b.net/free-win",
        "x://b.net/freewin", "x://b.net/free/free", "x://b.net/casinos", "x://b.net/é-CASINO", "a://b://c/d",
        "://", "x://" + "a" * 50_000,
    ]
    got = _judged(spark, urls)
    assert len(got) == len(urls)
    assert [(got[i].host, got[i].path, got[i].rule) for i in (0, 1, 2)] == [("", "", None)] * 3
    assert (got[3].host, got[3].path, got[3].rule) == ("www.example.org", "/es/x", "example.org/es/")
    assert (got[4].rule, got[4].verdict) == ("example.org/en/1", "block")
    assert (got[5].path, got[5].rule) == ("", None)
    assert [got[i].verdict for i in (2, 6, 7, 8, 9, 10, 11, 12)] == [
        "block", "block", "allow", "block", "allow", "allow", "allow", "block",
    ]
    assert (got[13].host, got[13].path) == ("b:", "//c/d")
    assert got[10].terms == ["free"] and got[10].weight == 0.5
    assert _judged(spark, ["x://b.net/casino"], vocabulary={})[0].verdict == "allow"


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_vocabulary.judged(pages).collect() == []


# --- embeddings ------------------------------------------------------------------------------


def _brute(rows, cosine):
    links = []
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a is None or b is None or len(a) != len(b) or not len(a):
                continue
            if None in a or None in b or not np.isfinite(a).all() or not np.isfinite(b).all():
                continue
            x, y = np.array(a, float), np.array(b, float)
            if x.any() and y.any() and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links.append((i, j))
    return links


def _check_vectors(spark, rows, cosine=0.95):
    frame = spark.createDataFrame(
        [(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, n bigint, cid bigint"
    )
    got = product_quantiser.linked(frame, cosine).collect()
    links = _brute([(i, v) for i, v in rows], cosine)
    root = components(len(rows), links)
    least = {}
    for (name, _), r in zip(rows, root):
        least[r] = min(name, least.get(r, name))
    degree = np.bincount([i for link in links for i in link], minlength=len(rows))
    want = [(name, int(d), least[r]) for (name, _), d, r in zip(rows, degree, root)]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("block", [16, 4096])
def test_clusters_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(product_quantiser, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 20))
    points = centres[rng.integers(0, 12, 240)] + rng.normal(scale=0.28, size=(240, 20))
    points = np.concatenate([points, points[:30], points[:10] * 3]).astype(np.float32)
    _check_vectors(spark, [(int(i), p.tolist()) for i, p in enumerate(points)])


def test_hot_group_along_few_directions_loses_no_link(spark):
    rng = np.random.default_rng(7)
    # A third of the vectors differ along three directions of 64 only.
    hot = rng.normal(size=64) + rng.normal(size=(500, 3)) @ rng.normal(scale=0.45, size=(3, 64))
    points = np.concatenate([hot, rng.normal(size=(1000, 64))]).astype(np.float32)
    rng.shuffle(points)
    _check_vectors(spark, [(int(i), p.tolist()) for i, p in enumerate(points)])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [1.0, 0.0],
        [2.0, 0.1], [1e-30, 0.0], [0.0, 1.0], [-1.0, 0.0],
    ]
    _check_vectors(spark, list(enumerate(vectors)))
    schema = "vec_id bigint, embedding array<float>"
    unnamed = spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0])], schema)
    got = {r.vec_id: (r.n_links, r.component_id) for r in product_quantiser.linked(unnamed).collect()}
    assert got[None] == (0, None)
    assert product_quantiser.linked(unnamed.limit(0)).collect() == []
    bad = spark.createDataFrame([(1, None)], schema)
    assert [tuple(r) for r in product_quantiser.linked(bad).collect()] == [(1, 0, 1)]


def test_vectors_of_several_lengths_and_lists(spark, monkeypatch):
    monkeypatch.setattr(product_quantiser, "BLOCK", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6))
    near = centres[rng.integers(0, 12, 300)] + 0.12 * rng.normal(size=(300, 6))
    rows = [[float(x) for x in v] for v in near] + [[1.0, 0.0, 0.1], [1.0, 0.0, 0.1], [1.0, 0.0, 0.0], [2.0], [3.0]]
    rows += rows[:30] + [rows[0]] * 50
    _check_vectors(spark, list(enumerate(rows)))


# --- conversations ---------------------------------------------------------------------------


def test_messages_are_taken_apart():
    text = "Hi.\n\nOn Monday Bo wrote:\n> First part\n> goes ON.\n>\n>> older\n> back\nmine"
    message = quotations.parsed(text)
    assert message.own == ["hi.", "mine"]
    assert message.quoted == [(1, "first part goes on."), (2, "older"), (1, "back")]
    assert message.own_text == "Hi.\n\nmine"
    assert quotations.parsed(None) == quotations.parsed("") == quotations.Message()
    assert quotations.parsed(">" * 500 + " deep").quoted == [(500, "deep")]


CHAT = [
    (1, 0, "a", "How are you?\n\nI bought a red car yesterday. It is very fast indeed."),
    (1, 1, "b", "> how ARE\n> you?\nFine."),
    (1, 2, "a", "Something else."),
    (1, 3, "b", ">> How are you?\n> Fine.\nGood."),
    (1, 4, "c", "> It is very fast indeed.\nNice."),
    (1, 5, "c", "> never written\nHm."),
    (2, 0, "a", "> Something else.\nFrom another talk."),
    (2, 1, "a", None),
    (2, 1, "a", ""),
    (None, 0, "a", "> Fine.\nLost."),
    (3, None, "a", "Fine."),
]


def test_replies_are_ordered(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, position string"
    frame = spark.createDataFrame([(*r, "x") for r in CHAT], schema)
    got = quotations.reply_ordered(frame).collect()
    assert len(got) == len(CHAT)
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in one] == [0, 1, 4, 3, 2, 5]
    assert [(r.reply_to, r.thread_turn, r.reply_depth) for r in one] == [
        (None, 0, 0), (0, 0, 1), (0, 0, 1), (1, 0, 2), (None, 2, 0), (None, 5, 0),
    ]
    assert [r.own_text for r in one][1] == "Fine."
    two = sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)
    assert [r.position for r in two] == [0, 1, 2]
    assert (two[0].n_quotes, two[0].n_linked, two[0].reply_to) == (1, 1, None)
    links = {(r.conv_id, r.turn, r.place): (r.from_conv, r.from_turn) for r in quotations.quote_links(frame).collect()}
    assert links[(1, 3, 0)] == (1, 0) and links[(1, 5, 0)] == (None, None)
    assert links[(2, 0, 0)] == (1, 2) and links[(None, 0, 0)] == (1, 1)
    assert quotations.reply_ordered(frame.limit(0)).collect() == []


def test_quotes_of_short_sentences_and_of_the_next_conversation(spark):
    chat = [
        (1, 0, "a", "Sounds good. We shall meet at five."),
        (1, 1, "b", "> Sounds good.\nYes. The hall is open until late tonight."),
        (1, 2, "a", "> The garden gate is closed today.\nThe garden gate is closed today."),
        (2, 0, "a", "The garden gate is closed today."),
        (2, 1, "a", "> Sounds good.\nOh."),
        (2, 2, "a", "> Yes. The hall is open until late tonight.\nFine."),
        (3, 0, "a", "> Oh.\nShort but whole."),
        (3, 1, "a", "Yes."),
        (3, 2, "a", "> Yes. The hall is open until late tonight.\nFine."),
    ]
    frame = spark.createDataFrame(chat, "conv_id bigint, turn bigint, role string, text string")
    links = {(r.conv_id, r.turn): (r.from_conv, r.from_turn) for r in quotations.quote_links(frame).collect()}
    assert links == {
        (1, 1): (1, 0), (1, 2): (2, 0), (2, 1): (None, None), (2, 2): (1, 1), (3, 0): (2, 1), (3, 2): (1, 1),
    }


def _passages(text):
    """(level, passage) of a message without attributions, level 0 its own; by another way than the operator."""
    runs, last = [], None
    for line in (text or "").split("\n"):
        level = len(re.match(r"[> \t]*", line).group().replace(" ", "").replace("\t", ""))
        body = line.lstrip("> \t").strip()
        if not body:
            last = None
        elif last == level:
            runs[-1][1].append(body)
        else:
            runs.append((level, [body]))
            last = level
    return [(level, " ".join(" ".join(lines).lower().split())) for level, lines in runs]


def _links(rows):
    """Where each quote comes from, every message asked in turn."""
    def sentences(passage):
        return re.split(r"(?<=[.!?]) ", passage)

    own = [(c, t, [p for level, p in _passages(text) if not level]) for c, t, text in rows]
    found = {}
    for conv, turn, text in rows:
        for place, (level, passage) in enumerate(q for q in _passages(text) if q[0]):
            long = [s for s in sentences(passage) if len(s.split()) >= 4]
            short = [s for s in sentences(passage) if len(s.split()) < 4]
            origin = (None, None)
            for part in [passage, *long, *short]:
                wide = part == passage or part in long
                here = [t for c, t, ps in own if c == conv and t is not None
                        and any(part == p or part in sentences(p) for p in ps)]
                there = [(c, t) for c, t, ps in own if c not in (conv, None) and t is not None
                         and any(part == p or (part in sentences(p) and len(part.split()) >= 4) for p in ps)]
                if here and min(here) < turn:
                    origin = (conv, min(here))
                elif wide and there:
                    origin = min(there)
                if origin[1] is not None:
                    break
            found[conv, turn, place] = (level, *origin)
    return found


def test_links_against_brute_force(spark):
    rng = random.Random(11)
    said = ["Yes.", "I see.", "We met in the park.", "The train was late again today.", "Who knows?", "It rained all day long."]
    rows = []
    for conv in range(12):
        for turn in range(6):
            lines = []
            for _ in range(rng.randrange(1, 4)):
                text = " ".join(rng.sample(said, rng.randrange(1, 4)))
                lines.append("> " * rng.randrange(3) + (text if rng.random() < 0.7 else f"{text} {conv % 4}"))
                lines += [""] * rng.randrange(2)
            rows.append((conv, turn, "\n".join(lines)))
    frame = spark.createDataFrame([(c, t, "a", x) for c, t, x in rows], "conv_id bigint, turn bigint, role string, text string")
    got = {
        (r.conv_id, r.turn, r.place): (r.level, r.from_conv, r.from_turn)
        for r in quotations.quote_links(frame).collect()
    }
    want = _links(rows)
    assert got == want and sum(v[1] is not None for v in want.values()) > 20


def test_long_threads_double_their_way_up(spark):
    chain = [(7, 0, "a", "message number 0")] + [
        (7, i, "a", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 40)
    ]
    frame = spark.createDataFrame(chain, "conv_id bigint, turn bigint, role string, text string")
    got = quotations.reply_ordered(frame).collect()
    assert all((r.thread_turn, r.reply_depth, r.position) == (0, r.turn, r.turn) for r in got)


def test_conversations_of_sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    got = QUERIES["op1_quotation_linking"](spark, sf_dir).collect()
    want = {(r.conv_id, r.turn): quotations.parsed(r.text) for r in rows}
    assert {(r.conv_id, r.turn): r.own_text for r in got} == {k: m.own_text for k, m in want.items()}
    assert all(r.n_quotes == len(want[r.conv_id, r.turn].quoted) for r in got)


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], sf_dir)
        path = scratch_path(spark, f"test-{len(seen)}")
        out.write.mode("overwrite").parquet(path)
        seen.append(spark.read.parquet(path))
        assert seen[-1].columns == names
    toxic, copies, leaks, mix = ({r.doc_id for r in df.select("doc_id").collect()} for df in seen[1:])
    scores = {r.doc_id: r.score for r in QUERIES["op8_toxicity"](spark, sf_dir).collect()}
    assert toxic == {d for d, s in scores.items() if s < 0.3}
    from tillweave.llm.anchors import grouped

    assert copies == {r.component_id for r in grouped(seen[1]).collect()}
    hit = {r.doc_id for r in QUERIES["op2_decontamination"](spark, sf_dir).collect() if r.contaminated}
    assert leaks == copies - hit and leaks < copies
    assert mix <= leaks
    last = corpus_pipeline.STAGES[-1][1](spark, seen[-1], sf_dir).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in seen[-1].collect())
    ends = sorted((r.start, r.start + r.n_tokens) for r in last)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_pipeline_on_empty_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
