"""Toxicity from a learned lexicon, misspellings of it, and the context of each hit.

The lexicon is learned from a bounded sample of labelled documents: words and
stems that toxic documents hold and others hardly do, each counted once among
copies.  In every text, words that
a Levenshtein automaton finds near a term of the lexicon's trie count as that
term, with a discount.  A hit counts less where its surroundings quote or report
it, and more where they address somebody.  A logistic curve over the summed and
the strongest hit gives the score.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.anchors import HASHED_BYTES, fingerprints
from tillweave.llm.levenshtein import Trie
from tillweave.llm.tables import id_remainder, stored

#: Labelled documents that lexicon and curve are fitted on, at most.
FIT_ROWS = 20_000
#: A term must be held by so many toxic documents, and so much rather by them (logarithm of odds).
MIN_SUPPORT = 6
#: Documents count once where so many words before or after a term are the same: a passage they share.
PASSAGE_WORDS = 5
MIN_ODDS = 1.8
#: Support times odds that a term must reach beyond what its kin explain.
MIN_GAIN = 25.0
#: Summed hits beyond which a text gets no more toxic.
MOST_HITS = 10.0
STEM_SIGNS = range(3, 9)
#: Sample texts whose SimHashes differ in so few bits are copies.
COPY_BITS = 10
THRESHOLD = 0.3
#: Bytes of text scored at once; the arrays over them take some thirty times as much.
SCORED_BYTES = 2 << 20

#: Terms of so many signs may be misspelled by one sign, longer ones by two.
FUZZY_FROM = 5
FUZZY_TWO_FROM = 9
SPELLING_DISCOUNT = 0.15

#: Words before a hit that report it, and words near it that address somebody.
REPORTING = frozenset(
    "said says saying called calls calling wrote writes quote quoted quotes quoting word words term"
    " slur slurs insult insults insulted zitat sagte nannte citation disait dit dijo palabra".split()
)
ADDRESS = frozenset("you your youre u are ihr du dein tu vous votre tus eres usted".split())
QUOTED_SHARE = 0.35
ADDRESS_SHARE = 1.2
NEAR_WORDS = 6
NEAR_BYTES = 160
_OPEN = (b"\xe2\x80\x9c", b"\xc2\xab", b"\xe2\x80\x9e")
_CLOSE = (b"\xe2\x80\x9d", b"\xc2\xbb", b"\xe2\x80\x9c")


@dataclass
class Model:
    """Weights of terms (a stem ends in ``*``) and of the curve."""

    terms: dict[str, float]
    curve: tuple[float, float, float]
    #: Words near a term that clean texts hold as well: words of their own, not misspellings.
    ordinary: frozenset[str] = frozenset()
    #: Whole words behind stems, with the stem each of them counts as.
    behind: dict[str, str] = field(default_factory=dict)
    stems: dict[str, str] = field(init=False)
    trie: Trie = field(init=False)

    def __post_init__(self) -> None:
        self.stems = {t[:-1]: t for t in self.terms if t.endswith("*")}
        whole = {t: t for t in self.terms if not t.endswith("*")}
        #: By spelling the term that it and words near it stand for.
        self.spelled = {w: t for w, t in (self.behind | whole).items() if len(w) >= FUZZY_FROM}
        fuzzy = list(self.spelled)
        self.trie = Trie(fuzzy)
        self.masks = np.array([_mask(t) for t in fuzzy], np.uint32)
        self.sizes = np.array([len(t) for t in fuzzy], np.int64)
        self.slack = np.array([_allowed(t) for t in fuzzy], np.int64)
        self.letters = [
            np.array([t.count(chr(c)) for c in range(0x61, 0x7B)], np.int64) for t in fuzzy
        ]
        self.memo: dict[bytes, tuple[str, int] | None] = {}

    def match(self, word: bytes, fuzzy: bool) -> tuple[str, int] | None:
        """The term that ``word`` stands for, and its distance."""
        text = word.decode("utf-8")
        if text in self.terms:
            return text, 0
        for size in STEM_SIGNS:
            if text[:size] in self.stems and len(text) >= size:
                return self.stems[text[:size]], 0
        if fuzzy and text not in self.ordinary:
            found = self.trie.nearest(text, 2, _allowed)
            if found:
                return self.spelled[found[1]], found[0]
        return None

    def matches(self, text: W.Words) -> dict[int, tuple[str, int]]:
        """By place in the dictionary: the term of each word that stands for one."""
        names = text.dictionary.cast(pa.large_string())
        near = self._may_be_near(text.dictionary)
        known = pc.is_in(names, pa.array(list(self.terms), pa.large_string()))
        for stem in self.stems:
            known = pc.or_(known, pc.starts_with(names, stem))
        some = np.flatnonzero(near | known.to_numpy(zero_copy_only=False).astype(bool))
        out = {}
        for place, word in zip(some.tolist(), text.dictionary.take(pa.array(some)).to_pylist()):
            if word not in self.memo:
                if len(self.memo) >= 100_000:
                    self.memo.clear()
                self.memo[word] = self.match(word, bool(near[place]))
            if self.memo[word]:
                out[place] = self.memo[word]
        return out

    def _may_be_near(self, dictionary: pa.Array) -> np.ndarray:
        """Words that by length and letters could be near a term; no near word is left out."""
        count = len(dictionary)
        out = np.zeros(count, bool)
        if not count or not len(self.sizes):
            return out
        data, bounds = W.raw_bytes(dictionary)
        masks = np.bitwise_or.reduceat(_SIGN[data], bounds[:-1])
        # Signs, not bytes: all but those that continue one.
        more_bytes = np.searchsorted(np.flatnonzero(data & 0xC0 == 0x80), bounds)
        sizes = np.diff(bounds) - np.diff(more_bytes)
        for mask, size, slack, letters in zip(self.masks, self.sizes, self.slack, self.letters):
            fits = (sizes >= size - slack) & (sizes <= size + slack)
            fits &= np.bitwise_count(mask & ~masks) <= slack
            fits &= np.bitwise_count(masks & ~mask & _LETTERS) <= slack
            some = np.flatnonzero(fits & ~out)
            # An edit adds, takes away or changes one letter.
            held = _letter_counts(data, bounds, some)
            more = np.maximum(held - letters, 0).sum(axis=1)
            less = np.maximum(letters - held, 0).sum(axis=1)
            out[some[np.maximum(more, less) <= slack]] = True
        return out


def _letter_counts(data: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How often each word of ``rows`` holds each of a-z."""
    sizes = bounds[rows + 1] - bounds[rows]
    letters = data[W.ragged(bounds[rows], sizes)].astype(np.int64) - 0x61
    owner = np.repeat(np.arange(len(rows)), sizes)
    inside = (letters >= 0) & (letters < 26)
    flat = np.bincount(owner[inside] * 26 + letters[inside], minlength=26 * len(rows))
    return flat.reshape(len(rows), 26)


_LETTERS = np.uint32((1 << 26) - 1)
_SIGN = np.full(256, 1 << 26, np.uint32)
_SIGN[0x61:0x7B] = np.uint32(1) << np.arange(26, dtype=np.uint32)


def _mask(term: str) -> int:
    return int(np.bitwise_or.reduce(_SIGN[np.frombuffer(term.encode(), np.uint8)]))


def _allowed(term: str) -> int:
    return 2 if len(term) >= FUZZY_TWO_FROM else 1 if len(term) >= FUZZY_FROM else 0


def _context(raw: bytes, at: int, end: int, before: list[bytes], around: list[bytes]) -> float:
    """How much a hit counts, from the text and the words near it."""
    line = raw[max(0, at - NEAR_BYTES) : at]
    line = line[line.rfind(b"\n") + 1 :]
    after = raw[end : end + NEAR_BYTES].split(b"\n")[0]
    quoted = line.lstrip().startswith(b">") or (line.count(b'"') % 2 == 1 and b'"' in after)
    for opened, closed in zip(_OPEN, _CLOSE):
        quoted = quoted or (line.rfind(opened) > line.rfind(closed) and closed in after)
    share = 1.0
    if quoted or any(w.decode("utf-8") in REPORTING for w in before):
        share *= QUOTED_SHARE
    if any(w.decode("utf-8") in ADDRESS for w in around):
        share *= ADDRESS_SHARE
    return share


def hit_features(texts: pa.Array, model: Model) -> np.ndarray:
    """Per text its summed hits, up to ``MOST_HITS``, and its strongest hit."""
    out = np.zeros((len(texts), 2))
    text = W.words(texts, W.PLAIN)
    found = model.matches(text)
    if not found:
        return out
    flagged = np.zeros(len(text.dictionary), bool)
    flagged[list(found)] = True
    places = np.flatnonzero(flagged[text.codes])
    owner = np.searchsorted(text.first, places, side="right") - 1
    data, bounds = W.raw_bytes(texts)
    # Where each hit begins in the raw bytes: words again, by the same table.
    inside = W.PLAIN[data] != W.GAP
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    starts[heads] = inside[heads]
    begin = np.flatnonzero(starts)
    for place, doc in zip(places.tolist(), owner.tolist()):
        term, distance = found[int(text.codes[place])]
        low = max(int(text.first[doc]), place - NEAR_WORDS)
        high = min(int(text.first[doc + 1]), place + NEAR_WORDS + 1)
        near = text.dictionary.take(pa.array(text.codes[low:high])).to_pylist()
        at = int(begin[place]) - int(bounds[doc])
        raw_start = int(bounds[doc])
        raw = data[max(raw_start, raw_start + at - NEAR_BYTES) : min(
            int(bounds[doc + 1]), raw_start + at + 3 * NEAR_BYTES
        )].tobytes()
        shift = min(at, NEAR_BYTES)
        size = int(text.offsets[place + 1] - text.offsets[place])
        strength = model.terms[term] * (1 - SPELLING_DISCOUNT * distance)
        strength *= _context(raw, shift, shift + size, near[: place - low], near)
        out[doc, 0] += strength
        out[doc, 1] = max(out[doc, 1], strength)
    out[:, 0] = np.minimum(out[:, 0], MOST_HITS)
    return out


def _terms_of(text: W.Words) -> Iterator[set[str]]:
    """Per text the words and stems that could become terms."""
    names = [w.decode("utf-8") for w in text.dictionary.to_pylist()]
    known = [
        {n, *(n[:k] + "*" for k in STEM_SIGNS if len(n) > k)} for n in names
    ]
    for first, last in zip(text.first[:-1], text.first[1:]):
        held: set[str] = set()
        for code in set(text.codes[first:last].tolist()):
            held |= known[code]
        yield held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic): texts that hold each term, toxic and in all."""
    for batch in W.gathered(batches):
        toxic: Counter = Counter()
        clean: Counter = Counter()
        for held, label in zip(
            _terms_of(W.words(batch.column(0), W.PLAIN)), batch.column(1).to_pylist()
        ):
            (toxic if label else clean).update(held)
        # What no toxic text of the chunk holds may still be held by one elsewhere.
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([toxic[n] for n in names], pa.int64()),
                pa.array([clean[n] for n in names], pa.int64()),
            ],
            names=["term", "toxic", "clean"],
        )


def _stems_of(term: str) -> list[str]:
    """Stems that ``term`` would count under; one that is a stem is its own."""
    letters = term.rstrip("*")
    return [letters[:k] + "*" for k in STEM_SIGNS if len(letters) >= k]


def _sides(text: W.Words, place: int, doc: int, hashes: list[int]) -> tuple[int | None, int | None]:
    """Hashes of the ``PASSAGE_WORDS`` before and after a word; None where the text has fewer."""
    first, last = int(text.first[doc]), int(text.first[doc + 1])

    def side(low: int, high: int) -> int | None:
        if low < first or high > last:
            return None
        return hash(tuple(hashes[c] for c in text.codes[low:high].tolist()))

    return side(place - PASSAGE_WORDS, place), side(place + 1, place + 1 + PASSAGE_WORDS)


def _held_terms(
    texts: pa.Array, toxic: list[bool], candidates: dict[str, float]
) -> Iterator[list[tuple[str, int | None, int | None]]]:
    """Per text the candidates it holds; in toxic texts once for each of their surroundings."""
    text = W.words(texts, W.PLAIN)
    terms: dict[int, list[str]] = {}
    hashes = []
    for code, word in enumerate(text.dictionary.to_pylist()):
        # Python's hash of bytes differs between processes, that of whole numbers does not.
        hashes.append(int.from_bytes(hashlib.blake2b(word, digest_size=7).digest()))
        name = word.decode("utf-8")
        forms = [name, *(name[:k] + "*" for k in STEM_SIGNS if len(name) > k)]
        if known := [f for f in forms if f in candidates]:
            terms[code] = known
    flagged = np.zeros(len(text.dictionary), bool)
    flagged[list(terms)] = True
    for doc, label in enumerate(toxic):
        low, high = int(text.first[doc]), int(text.first[doc + 1])
        held: set[tuple[str, int | None, int | None]] = set()
        for place in (low + np.flatnonzero(flagged[text.codes[low:high]])).tolist():
            sides = _sides(text, place, doc, hashes) if label else (None, None)
            held |= {(term, *sides) for term in terms[int(text.codes[place])]}
        yield sorted(held, key=str)


def _picked(
    rows: list[tuple[bool, list[tuple[str, int | None, int | None]]]], candidates: dict[str, float]
) -> dict[str, float]:
    """Candidates from the strongest on, each by what it explains beyond its kin before it.

    Words and the stems they share stand for the same documents; a term is taken
    only if enough toxic documents hold it and no related term taken before.
    Documents that hold a term only where earlier ones have the same words
    before or after it share a passage with them and do not count again.
    """
    holders: dict[str, set[int]] = {t: set() for t in candidates}
    apart: dict[str, set[int]] = {t: set() for t in candidates}
    seen: dict[str, set[tuple[bool, int]]] = {t: set() for t in candidates}
    clean: Counter = Counter()
    for number, (label, held) in enumerate(rows):
        if not label:
            clean.update({term for term, _, _ in held})
            continue
        for term, left, right in held:
            holders[term].add(number)
            if not {(True, left), (False, right)} & seen[term]:
                apart[term].add(number)
        for term, left, right in held:
            seen[term] |= {(a, side) for a, side in ((True, left), (False, right)) if side is not None}
    n_toxic = sum(label for label, _ in rows)
    n_clean = len(rows) - n_toxic
    # Of equally good terms the longest: a word before its stems.
    order = sorted(
        candidates, key=lambda t: (-len(apart[t]) * candidates[t], -len(t.rstrip("*")), t)
    )
    chosen: dict[str, float] = {}
    # Chosen terms by the stems they begin with.
    beginning: dict[str, list[str]] = {}
    for term in order:
        explained: set[int] = set()
        stems = _stems_of(term)
        # One of two related terms is a stem of the other.
        for other in {*(s for s in stems if s in chosen), *beginning.get(term, [])}:
            explained |= holders[other]
        support = len(apart[term] - explained)
        odds = math.log((support + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean[term] + 0.5))
        if support >= MIN_SUPPORT and odds >= MIN_ODDS and support * odds >= MIN_GAIN:
            chosen[term] = odds
            for stem in stems:
                beginning.setdefault(stem, []).append(term)
    return chosen


def _leaders(prints: np.ndarray) -> np.ndarray:
    """Fingerprints without those within ``COPY_BITS`` of an earlier one."""
    kept = np.zeros(0, np.uint64)
    for low in range(0, len(prints), 512):
        part = prints[low : low + 512]
        if len(kept):
            near = np.bitwise_count(part[:, None] ^ kept[None, :]) <= COPY_BITS
            part = part[~near.any(axis=1)]
        own = np.bitwise_count(part[:, None] ^ part[None, :]) <= COPY_BITS
        kept = np.concatenate([kept, part[~np.tril(own, -1).any(axis=1)]])
    return kept


def _fitted_curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's steps with a little shrinkage; hits never lower a score."""
    weights = np.array([-2.0, 0.3, 0.3])
    if not len(labels):
        return tuple(float(w) for w in weights)
    x = np.column_stack([np.ones(len(features)), features])
    free = [0, 1, 2]
    while True:
        fit = np.zeros(3)
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
            slope = x.T @ (p - labels) + 0.5 * fit
            bend = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
            step = np.linalg.solve(bend[np.ix_(free, free)], slope[free])
            fit[free] -= np.clip(step, -2, 2)
        below = [i for i in free[1:] if fit[i] < 0]
        if not below:
            return tuple(float(w) for w in fit)
        free.remove(min(below, key=lambda i: fit[i]))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most ``FIT_ROWS`` labelled ids, picked by a hash of the id; no copies.

    Ids whose crc32 leaves 2 modulo 4 are held out.  An id with several labels
    is toxic if one of them says so; null labels are none.  Of an id with several
    texts the one with the least hash is taken, null last.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(FIT_ROWS)
        .select(F.col("doc_id").alias("labelled"), (F.col("toxic") == 1).alias("toxic"))
    )
    # At most FIT_ROWS rows of nine bytes.
    first = F.min(F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("hash"), "text"))
    joined = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), F.col("doc_id") == F.col("labelled"))
        .groupBy("labelled", "toxic")
        .agg(first.alias("first"))
        .select("first.text", "toxic")
    )

    def printed(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = pa.array(fingerprints(batch.column(0)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), prints], names=["text", "toxic", "fp"]
        )

    rows = stored(
        joined.mapInArrow(W.per_chunk(printed, HASHED_BYTES), "text string, toxic boolean, fp bigint"),
        "toxicity-sample",
    )
    # Copies would make any word of a copied toxic text look toxic: one of them is enough.
    seen = rows.select("toxic", "fp").distinct().orderBy("fp").collect()
    kept = [
        (label, int(fp))
        for label in (False, True)
        for fp in _leaders(
            np.array([r.fp for r in seen if r.toxic == label], np.int64).view(np.uint64)
        ).view(np.int64)
    ]
    spark = docs.sparkSession
    leaders = spark.createDataFrame(kept, "toxic boolean, fp bigint")
    return stored(
        rows.dropDuplicates(["toxic", "fp"])
        .join(F.broadcast(leaders), ["toxic", "fp"])
        .select("text", "toxic"),
        "toxicity-leaders",
    )


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 4) == 2


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and curve.  Without labels the lexicon is empty and every score alike."""
    sample = labelled_sample(docs, labels).repartition(24)
    totals = sample.agg(
        F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean")
    ).first()
    odds = F.log(
        ((F.col("toxic") + 0.5) / (totals.toxic + 1)) / ((F.col("clean") + 0.5) / (totals.clean + 1))
    )
    # A term explains at most what it is counted for, so the rest cannot be picked.
    worth = F.col("toxic") * odds
    best = (
        sample.select("text", "toxic")
        .mapInArrow(_counted, "term string, toxic bigint, clean bigint")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= MIN_SUPPORT) & (odds >= MIN_ODDS) & (worth >= MIN_GAIN - 1e-6))
        .select("term", odds.alias("odds"))
        .collect()
    )
    candidates = {r.term: r.odds for r in best}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches):
            found = list(_held_terms(batch.column(0), batch.column(1).to_pylist(), candidates))
            columns = [
                pa.array([[h[part] for h in held] for held in found], pa.list_(kind))
                for part, kind in enumerate((pa.string(), pa.int64(), pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *columns], names=["toxic", "held", "left", "right"]
            )

    # At most FIT_ROWS rows, each with candidates only.
    rows = sample.mapInArrow(
        held, "toxic boolean, held array<string>, left array<bigint>, right array<bigint>"
    ).collect()
    listed = [(r.toxic, list(zip(r.held, r.left, r.right))) for r in rows]
    # Sorted, as which of the documents that share a passage counts depends on the order.
    terms = _picked(sorted(listed, key=str), candidates)
    model = Model(terms, (-3.0, 0.3, 0.3), behind=_behind(sample, terms, odds))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches):
            text = W.words(batch.column(0), W.PLAIN)
            near = [p for p, (_, distance) in model.matches(text).items() if distance]
            words, owner = text.codes, text.owner()
            pairs = {
                (int(d), int(c))
                for d, c in zip(owner[np.isin(words, near)], words[np.isin(words, near)])
            }
            toxic = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([text.dictionary[c].as_py().decode() for _, c in pairs], pa.string()),
                    pa.array([toxic[d] for d, _ in pairs], pa.bool_()),
                ],
                names=["word", "toxic"],
            )

    # Words within two signs of the lexicon that the sample holds.
    variants = (
        sample.mapInArrow(spelled, "word string, toxic boolean")
        .groupBy("word")
        .agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"))
        .where((F.col("clean") > 0) & (odds < MIN_ODDS))
        .collect()
    )
    model = Model(model.terms, model.curve, frozenset(r.word for r in variants), model.behind)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches):
            found = hit_features(batch.column(0), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found[:, 0]), pa.array(found[:, 1])],
                names=["toxic", "total", "strongest"],
            )

    fit = sample.mapInArrow(measured, "toxic boolean, total double, strongest double").collect()
    features = np.array([(r.total, r.strongest) for r in fit]).reshape(-1, 2)
    curve = _fitted_curve(features, np.array([float(r.toxic) for r in fit]))
    return Model(model.terms, curve, model.ordinary, model.behind)


def _behind(sample: DataFrame, terms: dict[str, float], odds: Column) -> dict[str, str]:
    """Whole words of the sample that a stem of ``terms`` stands for, so that they can be misspelled.

    Only words that toxic texts hold much rather than others: what is near an
    ordinary word is no misspelling of an insult.
    """
    stems = {t for t in terms if t.endswith("*")}

    def stemmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches):
            words, stands, toxic = [], [], []
            held = _terms_of(W.words(batch.column(0), W.PLAIN))
            for names, label in zip(held, batch.column(1).to_pylist()):
                for name in names:
                    if name.endswith("*"):
                        continue
                    # The shortest stem, as in matching.
                    stem = next((s for k in STEM_SIGNS if (s := name[:k] + "*") in stems), None)
                    if stem and len(name) >= len(stem) - 1:
                        words.append(name)
                        stands.append(stem)
                        toxic.append(label)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(stands, pa.string()), pa.array(toxic, pa.bool_())],
                names=["word", "stem", "toxic"],
            )

    if not stems:
        return {}
    found = (
        sample.select("text", "toxic")
        .mapInArrow(stemmed, "word string, stem string, toxic boolean")
        .groupBy("word", "stem")
        .agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"))
        .where((F.col("toxic") > 0) & (odds >= MIN_ODDS))
        .collect()
    )
    return {r.word: r.stem for r in found}


def _scores(texts: pa.Array, model: Model) -> np.ndarray:
    base, total, strongest = model.curve
    found = hit_features(texts, model)
    value = base + total * found[:, 0] + strongest * found[:, 1]
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and score.

    A null or empty text has no hit and gets the score of any text without one.
    Null and repeated ids are passed on; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.gathered(batches, size=SCORED_BYTES):
            found = _scores(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found)], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")


def tolerable(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``threshold``, columns as given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return W.rows_where(
        docs, lambda texts: _scores(texts, shared.value) < threshold, size=SCORED_BYTES
    )
