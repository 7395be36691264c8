"""Probability of words as the sum over all their segmentations into vocabulary pieces."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np

#: Stands for the space before a word in the vocabulary.
SPACE = "▁"


@dataclass
class Vocabulary:
    """Pieces with natural logarithms of their weights, and those of the 256 byte pieces."""

    weights: dict[str, float]
    byte_weights: list[float]
    end: float

    def __post_init__(self) -> None:
        # Every beginning of a piece; what is no piece itself has no weight.
        self.beginnings: dict[str, float | None] = {}
        for piece in self.weights:
            for size in range(1, len(piece)):
                self.beginnings.setdefault(piece[:size], None)
        self.beginnings.update(self.weights)

    def of_bytes(self, sign: str) -> float:
        return sum([self.byte_weights[b] for b in sign.encode("utf-8")])


def prior_vocabulary(model_file: str, byte_share: float = 1e-4) -> Vocabulary:
    """Weights from the scores of a sentencepiece model.

    Scores of a unigram model are logarithms and are taken as such.  Those of
    the merging kind are minus a piece's rank, which weighs it by 1 / (1 + rank).
    Control pieces are left out; byte pieces share ``byte_share``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    ranks = min(scores.values()) < -1000
    raw = {p: 1 / (1 - s) if ranks else math.exp(s) for p, s in scores.items()}
    total = sum(raw.values())
    share = 1 - 2 * byte_share
    weights = {p: math.log(w * share / total) for p, w in raw.items()}
    return Vocabulary(weights, [math.log(byte_share / 256)] * 256, math.log(byte_share))


def reweighted(
    prior: Vocabulary, expected: Mapping[str, float], ends: float, smoothing: float
) -> Vocabulary:
    """Weights in proportion to expected counts plus ``smoothing`` times the prior weight.

    Byte pieces are counted under ``<0xNN>``.
    """
    total = sum(expected.values()) + ends + smoothing

    def weight(name: str, before: float) -> float:
        return math.log((expected.get(name, 0.0) + smoothing * math.exp(before)) / total)

    return Vocabulary(
        {p: weight(p, w) for p, w in prior.weights.items()},
        [weight(f"<0x{i:02X}>", w) for i, w in enumerate(prior.byte_weights)],
        math.log((ends + smoothing * math.exp(prior.end)) / total),
    )


_NONE = object()


def _lattice(word: str, vocabulary: Vocabulary) -> tuple[list[list], list[float]]:
    """By end place (start, weight) of all pieces that end there, and the forward logarithms.

    A sign that no piece of its own covers is spelled in bytes.
    """
    look, weights, log, exp = vocabulary.beginnings.get, vocabulary.weights, math.log, math.exp
    n = len(word)
    into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    forward = [0.0] * (n + 1)
    for start in range(n):
        if start:
            edges = into[start]
            if len(edges) == 1:
                before, weight = edges[0]
                forward[start] = forward[before] + weight
            else:
                terms = [forward[before] + weight for before, weight in edges]
                top = max(terms)
                forward[start] = top + log(sum([exp(t - top) for t in terms]))
        if word[start] not in weights:
            into[start + 1].append((start, vocabulary.of_bytes(word[start])))
        for end in range(start + 1, n + 1):
            weight = look(word[start:end], _NONE)
            if weight is _NONE:
                break
            if weight is not None:
                into[end].append((start, weight))
    terms = [forward[before] + weight for before, weight in into[n]]
    top = max(terms)
    forward[n] = top + log(sum([exp(t - top) for t in terms]))
    return into, forward


def log_probability(word: str, vocabulary: Vocabulary) -> float:
    """Natural logarithm of the summed weight of all segmentations, by forward recursion."""
    return _lattice(SPACE + word, vocabulary)[1][-1]


def expected_counts(
    words: Iterable[tuple[str, int]], vocabulary: Vocabulary, into: dict[str, float]
) -> None:
    """Add to ``into`` how often each piece is expected in ``words``, (word, times) each."""
    exp, log, weights = math.exp, math.log, vocabulary.weights
    for word, times in words:
        word = SPACE + word
        edges, forward = _lattice(word, vocabulary)
        n = len(word)
        # What a place is left by so far: the logarithm of all ways from it to the end.
        backward: list[float | None] = [None] * (n + 1)
        backward[n] = 0.0
        total = forward[n]
        for end in range(n, 0, -1):
            behind = backward[end]
            if behind is None:
                continue
            for start, weight in edges[end]:
                ahead = weight + behind
                held = backward[start]
                if held is None:
                    backward[start] = ahead
                elif held > ahead:
                    backward[start] = held + log(1.0 + exp(ahead - held))
                else:
                    backward[start] = ahead + log(1.0 + exp(held - ahead))
                share = exp(forward[start] + ahead - total) * times
                piece = word[start:end]
                if piece in weights:
                    into[piece] = into.get(piece, 0.0) + share
                else:
                    for b in piece.encode("utf-8"):
                        name = f"<0x{b:02X}>"
                        into[name] = into.get(name, 0.0) + share


#: Words of more signs are worked through one by one.
LONG_WORD = 64
_HASH = np.uint64(0x9E3779B97F4A7C15)


class Lattices:
    """The same sums for many words at once, as array operations over all their signs.

    Pieces are found by hashes that grow sign by sign; a place is followed only
    as long as what begins there begins some piece.  Edges are then worked
    through by their start's place in the word and by length, in groups whose
    ends differ, so that each group is one addition of logarithms.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = list(vocabulary.weights)
        number = {p: i for i, p in enumerate(self.pieces)}
        self.weights = np.array([vocabulary.weights[p] for p in self.pieces])
        by_size: dict[int, list[tuple[int, int]]] = {}
        for text in vocabulary.beginnings:
            by_size.setdefault(len(text), []).append((_hash(text), number.get(text, -1)))
        #: By length: the sorted hashes of all beginnings, and which piece each is, or -1.
        self.tables = []
        for size in range(1, max(by_size, default=0) + 1):
            hashes, numbers = zip(*sorted(by_size[size]))
            self.tables.append((np.array(hashes, np.uint64), np.array(numbers, np.int64)))

    def _edges(self, signs: np.ndarray, room: np.ndarray):
        """(start, length, piece, weight) of all edges; piece -1 is a sign spelled in bytes."""
        starts, lengths, pieces = [], [], []
        alive = np.arange(len(signs))
        hashes = np.zeros(len(signs), np.uint64)
        covered = np.zeros(len(signs), bool)
        for size, (known, numbers) in enumerate(self.tables, 1):
            fits = room[alive] >= size
            alive, hashes = alive[fits], hashes[fits]
            if not len(alive):
                break
            hashes = (hashes + signs[alive + size - 1]) * _HASH
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found = known[at] == hashes
            alive, hashes, piece = alive[found], hashes[found], numbers[at[found]]
            real = piece >= 0
            starts.append(alive[real])
            pieces.append(piece[real])
            lengths.append(np.full(int(real.sum()), size))
            if size == 1:
                covered[alive[real]] = True
        bare = np.flatnonzero(~covered)
        odd, which = np.unique(signs[bare], return_inverse=True)
        spelled = np.array([self.vocabulary.of_bytes(chr(int(c))) for c in odd])
        start = np.concatenate([*starts, bare])
        piece = np.concatenate([*pieces, np.full(len(bare), -1)])
        length = np.concatenate([*lengths, np.ones(len(bare), np.int64)])
        weight = np.where(piece >= 0, self.weights[piece], 0.0)
        weight[len(weight) - len(bare) :] = spelled[which] if len(bare) else 0.0
        return start, length, piece, weight

    def sums(self, words: Sequence[str], times: np.ndarray | None = None):
        """Natural logarithm of each word's probability; with ``times`` also expected counts.

        The counts are an array by piece and one by byte.
        """
        marked = [SPACE + w for w in words]
        sizes = np.array([len(w) for w in marked], np.int64)
        # One place more per word than signs: where the word ends.
        first = np.cumsum(sizes + 1) - (sizes + 1)
        raw = "\0".join(marked) + "\0"
        codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        offset = np.arange(len(codes)) - np.repeat(first, sizes + 1)
        place = np.flatnonzero(offset < np.repeat(sizes, sizes + 1))
        room = np.zeros(len(codes), np.int64)
        room[place] = (np.repeat(sizes, sizes + 1) - offset)[place]
        inner_start, length, piece, weight = self._edges(
            codes[place].astype(np.uint64), room[place]
        )
        start = place[inner_start]
        end = start + length
        key = offset[start] * 64 + length
        order = np.argsort(key, kind="stable")
        start, end, piece, weight, key = (x[order] for x in (start, end, piece, weight, key))
        cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        groups = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        forward = np.full(len(codes), -np.inf)
        forward[first] = 0.0
        for g in groups:
            forward[end[g]] = np.logaddexp(forward[end[g]], forward[start[g]] + weight[g])
        total = forward[first + sizes]
        if times is None:
            return total
        backward = np.full(len(codes), -np.inf)
        backward[first + sizes] = 0.0
        for g in reversed(groups):
            backward[start[g]] = np.logaddexp(backward[start[g]], backward[end[g]] + weight[g])
        word = np.searchsorted(first, start, side="right") - 1
        share = np.exp(forward[start] + weight + backward[end] - total[word]) * times[word]
        by_piece = np.bincount(piece + 1, weights=share, minlength=len(self.pieces) + 1)[1:]
        by_byte = np.zeros(256)
        odd, which = np.unique(codes[start[piece < 0]], return_inverse=True)
        for code, held in zip(odd, np.bincount(which, weights=share[piece < 0])):
            for b in chr(int(code)).encode("utf-8"):
                by_byte[b] += held
        return total, by_piece, by_byte


def _hash(text: str) -> int:
    value = 0
    for sign in text:
        value = (value + ord(sign)) * int(_HASH) % (1 << 64)
    return value


def log_probabilities(words: Sequence[str], lattices: Lattices) -> np.ndarray:
    """``log_probability`` of many words."""
    out = np.empty(len(words))
    short = [i for i, w in enumerate(words) if len(w) < LONG_WORD]
    if short:
        out[short] = lattices.sums([words[i] for i in short])
    for i, word in enumerate(words):
        if len(word) >= LONG_WORD:
            out[i] = log_probability(word, lattices.vocabulary)
    return out


def add_expected(
    words: Sequence[str], times: np.ndarray, lattices: Lattices, into: dict[str, float]
) -> None:
    """``expected_counts`` of many words."""
    short = [i for i, w in enumerate(words) if len(w) < LONG_WORD]
    if short:
        _, by_piece, by_byte = lattices.sums([words[i] for i in short], times[short])
        for i in np.flatnonzero(by_piece).tolist():
            piece = lattices.pieces[i]
            into[piece] = into.get(piece, 0.0) + float(by_piece[i])
        for b in np.flatnonzero(by_byte).tolist():
            name = f"<0x{b:02X}>"
            into[name] = into.get(name, 0.0) + float(by_byte[b])
    long = ((w, int(n)) for w, n in zip(words, times) if len(w) >= LONG_WORD)
    expected_counts(long, lattices.vocabulary, into)
