"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import re

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKENS = re.compile("[^\x20\x09-\x0d]+")

#: Texts with awkward shapes, used by every operator's test of edge cases.
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "word",
    "É ß 中文 😀 ́x",
    "a\x00b \x0b c",
    "same text again and again",
    "same text again and again",
    "x" * 50_000,
    "long " * 20_000,
]


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORDS.findall(lower(text))


def tokens(text: str | None) -> list[str]:
    return TOKENS.findall(lower(text))


def odd_docs(spark, extra: str = "doc_id bigint, text string, lang string, source string"):
    """The odd texts with null ids and sources, a repeated row, and columns named like inner ones."""
    rows = [
        (None if i == 3 else i, t, None, None if i % 3 == 0 else f"s{i % 2}", i, i, "a", "b")
        for i, t in enumerate(ODD_TEXTS)
    ]
    rows.append(rows[6])
    return spark.createDataFrame(
        rows, f"{extra}, copies bigint, fp bigint, _id string, word string"
    )


def components(count: int, links) -> list[int]:
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]
