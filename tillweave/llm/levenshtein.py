"""Words near a lexicon: Levenshtein automata run along a trie of terms."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class LevenshteinAutomaton:
    """Accepts what is within ``most`` insertions, deletions or changes of ``word``.

    A state is the row of edit distances between what was read and the prefixes
    of the word, cut off above ``most``.
    """

    def __init__(self, word: str, most: int):
        self.word, self.most = word, most

    def start(self) -> tuple[int, ...]:
        return tuple(min(i, self.most + 1) for i in range(len(self.word) + 1))

    def step(self, state: tuple[int, ...], sign: str) -> tuple[int, ...]:
        over = self.most + 1
        row = [min(state[0] + 1, over)]
        for i, own in enumerate(self.word):
            row.append(min(row[i] + 1, state[i] + (own != sign), state[i + 1] + 1, over))
        return tuple(row)

    def distance(self, state: tuple[int, ...]) -> int | None:
        return state[-1] if state[-1] <= self.most else None

    def alive(self, state: tuple[int, ...]) -> bool:
        return min(state) <= self.most


class Trie:
    """Terms by their signs; ``""`` holds the term that ends at a node."""

    def __init__(self, terms: Iterable[str]):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for sign in term:
                node = node.setdefault(sign, {})
            node[""] = term

    def nearest(
        self, word: str, most: int, allowed: Callable[[str], int] | None = None
    ) -> tuple[int, str] | None:
        """Distance and term of the nearest term within ``most``; the least of equally near ones.

        Terms farther away than ``allowed`` says of them are passed over.
        """
        automaton = LevenshteinAutomaton(word, most)
        best: tuple[int, str] | None = None
        open_nodes = [(self.root, automaton.start())]
        while open_nodes:
            node, state = open_nodes.pop()
            for sign, below in node.items():
                if sign == "":
                    distance = automaton.distance(state)
                    if distance is None or (allowed and distance > allowed(below)):
                        continue
                    if best is None or (distance, below) < best:
                        best = (distance, below)
                    continue
                onward = automaton.step(state, sign)
                if automaton.alive(onward):
                    open_nodes.append((below, onward))
        return best
