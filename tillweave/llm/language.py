"""Language of a text: the nearest of several centroids per language, by cosine.

A text is the letters of its words, lower-cased, with one gap between words.
Its runs of one to three signs are counted in hashed buckets; a count weighs
``log(1 + count)`` times the bucket's inverse document frequency, and the vector
has length one.  Per language the vectors of a bounded sample of labelled texts
are clustered by cosine into a few centroids, so that a language of several
kinds of text is not one blurred mean.  A text goes to the language of its
nearest centroid, and is rejected if it is further from it than nearly all texts
of that language are.

Document frequencies are counted over every labelled text.  The sample that the
centroids are fitted on has about ``PER_LANGUAGE`` texts of a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm import words as W
from tillweave.llm.tables import id_remainder, stored

#: Buckets that runs of signs are hashed into.
DIMS = 8192
LONGEST_RUN = 3
#: Texts of a language, give or take the chance of a hash, that its centroids are fitted on.
PER_LANGUAGE = 1500
CENTROIDS = 4
ROUNDS = 12
#: Share of a language's sampled texts that lie further from its centroids than others accept.
REJECTED_SHARE = 0.005
UNDETERMINED = "und"

#: Texts whose counts are held as rows at once.
_ROWS = 256
_CHUNK_BYTES = 1 << 20
# Multipliers of the signs of a run; odd numbers without a pattern.
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_SHIFT = 64 - DIMS.bit_length() + 1


@cache
def _signs() -> np.ndarray:
    """Every code point's sign: its lower-case form if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        sign = chr(code)
        if sign.isalpha():
            low = sign.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def counts_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of texts: the first text's place, counts by bucket, and which texts have a letter."""
    for start in range(0, len(texts), _ROWS):
        block = texts.slice(start, _ROWS)
        rows = block.to_pylist()
        # A gap before, between and behind texts keeps runs apart.
        whole = "\n" + "\n".join([t or "" for t in rows]) + "\n"
        signs = _signs()[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.array([len(t or "") + 1 for t in rows])
        owner = np.append(0, np.repeat(np.arange(len(rows)), sizes))
        # Of several gaps only the last stays.
        kept = (signs > 0) | np.append(signs[1:] > 0, True)
        signs, owner = signs[kept].astype(np.uint64), owner[kept]
        lettered = np.bincount(owner[signs > 0], minlength=len(rows)) > 0
        counts = np.zeros(len(rows) * DIMS, np.int64)
        hashed = np.zeros(len(signs), np.uint64)
        with np.errstate(over="ignore"):
            for n in range(LONGEST_RUN):
                last = len(signs) - n
                if last <= 0:
                    break
                hashed = hashed[:last] * np.uint64(_MIX[1]) + (signs[n:] + np.uint64(1)) * np.uint64(_MIX[0])
                hashed ^= hashed >> np.uint64(29)
                bucket = (hashed * np.uint64(_MIX[2])) >> np.uint64(_SHIFT)
                # A gap may begin or end a run but is none alone, and lies not between words.
                inside = signs[n:] > 0 if n == 0 else np.ones(last, bool)
                for k in range(1, n):
                    inside &= signs[k : last + k] > 0
                # A run belongs to the text of its first letter, which a gap may precede.
                of = owner[n:] if n == 0 else np.where(signs[:last] > 0, owner[:last], owner[1 : last + 1])
                place = of[inside] * DIMS + bucket[inside].astype(np.int64)
                counts += np.bincount(place, minlength=len(counts))
        yield start, counts.reshape(len(rows), DIMS), lettered


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; a text without signs stays zero."""
    vectors = np.log1p(counts, dtype=np.float32) * idf
    size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
    vectors /= np.where(size > 0, size, 1)[:, None].astype(np.float32)
    return vectors


@dataclass(frozen=True)
class Model:
    """``centroids[i]`` belongs to ``languages[i]``; ``reach[i]`` is the least cosine it accepts."""

    languages: list[str]
    centroids: np.ndarray
    reach: np.ndarray
    idf: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's nearest centroid, ties to the first, and the cosine between."""
        cosines = unit_rows(counts, self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0, 1)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id's text divisible by 5."""
    return id_remainder(doc_id, 5) == 0


def document_frequencies(learned: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts with a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts = np.zeros(DIMS, np.int64), 0
        for batch in W.chunks(batches, size=_CHUNK_BYTES):
            for _, counts, lettered in counts_of(batch.column(0)):
                found += (counts > 0).sum(axis=0)
                texts += int(lettered.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMS + 1)), pa.array(np.append(found, texts))], ["bucket", "n"]
        )

    # One row per bucket, whatever the table.
    rows = (
        learned.select("text")
        .mapInArrow(run, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    total = np.zeros(DIMS + 1, np.int64)
    for row in rows:
        total[row.bucket] = row.n
    return total[:-1], int(total[-1])


def sampled(learned: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of some ``per_language`` texts of each language, those of the least hashes.

    The share that is kept of a language follows from its number of texts, so no
    language is gathered in one place or sorted.
    """
    sizes = learned.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = stored(sizes.select(F.col("lang").alias("_lang"), "n"), "language-sizes")
    hashed = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    return learned.join(sizes, learned["lang"] == sizes["_lang"]).where(
        hashed * F.col("n") < per_language
    ).select("lang", "text")


def clustered(vectors: np.ndarray, centroids: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of unit vectors by cosine; the start takes, each time, the vector least covered."""
    mean = vectors.mean(axis=0, dtype=np.float64)
    picked = [int(np.argmax(vectors @ mean.astype(np.float32)))]
    nearest = vectors @ vectors[picked[0]]
    while len(picked) < min(centroids, len(vectors)):
        at = int(np.argmin(nearest))
        if nearest[at] > 1 - 1e-5:
            break
        picked.append(at)
        nearest = np.maximum(nearest, vectors @ vectors[at])
    held = vectors[picked]
    for _ in range(rounds):
        mine = np.argmax(vectors @ held.T, axis=1)
        sums = np.stack([vectors[mine == k].sum(axis=0, dtype=np.float64) for k in range(len(held))])
        size = np.linalg.norm(sums, axis=1)
        new = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], held)
        if np.allclose(new, held, atol=1e-6):
            break
        held = new.astype(np.float32)
    return held


def trained(
    docs: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS
) -> Model:
    """A model of the rows of ``docs`` (doc_id, text, lang) that are not held out.

    Rows with a null text or lang, or without a letter, teach nothing.  Texts
    that repeat count as often as they occur, but enter the sample together.
    Without any row to learn from the model has no language.
    """
    learned = docs.where(~held_out(F.col("doc_id"))).select("text", "lang")
    learned = learned.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    found, texts = document_frequencies(learned)
    idf = np.log((1 + texts) / (1 + found)).astype(np.float32) + np.float32(1)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # A language's sample; its size is bounded by ``per_language``.
        parts = []
        # Equal texts have one hash, so a passage that many rows share may come often: once is enough.
        rows = pa.array(sorted(set(group["text"])))
        for _, counts, lettered in counts_of(rows):
            parts.append(unit_rows(counts, idf)[lettered])
        vectors = np.concatenate(parts)
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []}, dtype=object)
        held = clustered(vectors, centroids)
        close = np.max(vectors @ held.T, axis=1)
        reach = float(np.quantile(close, REJECTED_SHARE))
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centroid": [c.tolist() for c in held], "reach": reach}
        )

    # A language's repeated texts are one row, so copies cannot swell a sample.
    sample = sampled(learned, per_language).distinct()
    rows = sample.groupBy("lang").applyInPandas(fit, "lang string, centroid array<float>, reach double")
    # A few rows per language, each of DIMS numbers.
    rows = sorted(rows.collect(), key=lambda r: (r.lang, r.centroid))
    return Model(
        [r.lang for r in rows],
        np.array([r.centroid for r in rows], np.float32).reshape(len(rows), DIMS),
        np.array([r.reach for r in rows]),
        idf,
    )


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, nearest, score, rejected.

    ``nearest`` is the language of the nearest centroid, null for a text that is
    null or empty or has no letter, or if the model has no language.  ``score``
    is the cosine, 0 without a language.  ``rejected`` tells that the text is
    further from its centroid than the model accepts, or has no language.  Long
    texts are read whole; rows that repeat or have no id are judged as any other;
    other columns are not looked at.  An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        names, scores, rejected = [], [], []
        for _, counts, lettered in counts_of(batch.column(1)):
            if not known.languages:
                lettered = np.zeros(len(counts), bool)
                best, cosine = np.zeros((2, len(counts)), np.int64)
                far = ~lettered
            else:
                best, cosine = known.nearest(counts)
                far = ~lettered | (cosine < known.reach[best])
            names += [known.languages[i] if ok else None for i, ok in zip(best, lettered)]
            scores.append(np.where(lettered, cosine, 0.0))
            rejected.append(far)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(names, pa.string()),
                pa.array(np.concatenate([np.zeros(0), *scores])),
                pa.array(np.concatenate([np.zeros(0, bool), *rejected])),
            ],
            ["doc_id", "nearest", "score", "rejected"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        W.per_chunk(run, _CHUNK_BYTES), f"doc_id {kind}, nearest string, score double, rejected boolean"
    )
