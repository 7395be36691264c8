"""URL filter: longest host and path rules, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A strict term rejects alone; soft terms reject when their weights sum to 1.
STRICT = 1.0
VOCABULARY: dict[str, float] = {
    **dict.fromkeys(["casino", "escort", "malware", "phishing", "porn", "viagra", "xxx"], STRICT),
    **dict.fromkeys(
        "adult bet bets bonus cheap crack deals farm free jackpot loan pills poker prize sex spam"
        " torrent warez win".split(),
        0.5,
    ),
}


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass
class UrlFilter:
    """Rules by host, and the automaton of the vocabulary; built once per task."""

    rules: Sequence[Rule]
    vocabulary: Mapping[str, float]
    by_host: dict = field(init=False)

    def __post_init__(self) -> None:
        import ahocorasick

        self.by_host = {}
        for rule in self.rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.automaton = ahocorasick.Automaton()
        for term in self.vocabulary:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def rule_for(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones that with the longer host."""
        best = None
        while host:
            for rule in self.by_host.get(host, ()):
                if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                    best = rule
            host = host.partition(".")[2]
        return best

    def terms(self, url: str) -> list[str]:
        """Distinct terms that stand between other signs than ASCII letters and digits."""
        text = url.encode("utf-8").lower().decode("utf-8")
        found = set()
        if self.vocabulary:
            for end, term in self.automaton.iter(text):
                start = end + 1 - len(term)
                if not (
                    (start and _alnum(text[start - 1]))
                    or (end + 1 < len(text) and _alnum(text[end + 1]))
                ):
                    found.add(term)
        return sorted(found)


def _alnum(sign: str) -> bool:
    return sign.isascii() and sign.isalnum()


def judged(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    vocabulary: Mapping[str, float] = VOCABULARY,
) -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, rule, terms, weight and verdict.

    Terms must be lower case.  A null url, or one without ``://``, has an empty
    host and path; its vocabulary is still looked at, and a null holds no term.
    Repeated rows are judged alike, each on its own; an empty table gives none.
    """
    schema = (
        "page_id bigint, host string, path string, rule string, terms array<string>,"
        " weight double, verdict string"
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge_of = UrlFilter(rules, vocabulary)
        for batch in batches:
            names, verdicts, terms, weights = [], [], [], []
            for url, host, path in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                rule = judge_of.rule_for(host, path)
                hits = judge_of.terms(url or "")
                weight = float(sum(vocabulary[t] for t in hits))
                names.append(rule.text if rule else None)
                terms.append(hits)
                weights.append(weight)
                verdicts.append(
                    rule.verdict if rule else "block" if weight >= STRICT else "allow"
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array(names, pa.string()),
                    pa.array(terms, pa.list_(pa.string())),
                    pa.array(weights, pa.float64()),
                    pa.array(verdicts, pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "terms", "weight", "verdict"],
            )

    url = F.col("url")
    return pages.select("page_id", "url", url_host(url).alias("host"), url_path(url).alias("path")).mapInArrow(
        judge, schema
    )
