"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
trigram is bound from its letters: the vector of the first rotated twice, times
that of the second rotated once, times that of the third. A text is the bundle
(sum) of its trigrams, a language the bundle of its training texts, and a text
has the language whose prototype has the largest cosine to it.

Texts are lower-cased; every run of characters that are not letters is one
space. Training sums integer vectors, so the order of tasks does not matter;
each task sends one vector per language. The model is ``dims`` numbers for each
language: bounded by the number of languages, whatever the data.

Cases: a text that is null, or has no letter, is ``und`` with score 0, and so is
every text when nothing could be learned; ``identified`` drops the former only.
Documents without a language do not teach. Of equal cosines, the language first by code point wins. Repeated rows are
scored alike; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, free_name, giving_back, slices

DIMS = 1024
SEED = 7
UNKNOWN = "und"
#: Trigram vectors a task keeps: 12,288 of 4 KB each. Beyond that it starts afresh.
_KEPT = 12_288
_BITS = np.int64(21)  # of a code point


class _Space:
    """Letter and trigram vectors of one task."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed = dims, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.matrix = np.empty((_KEPT, dims), dtype=np.float32)
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Different trigrams of a text and how often each occurs."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        letter = self.is_letter[codes]
        if not letter.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of a run of others, the first
        line = np.concatenate(([32], codes[keep], [32]))
        keys = (line[:-2] << 2 * _BITS) | (line[1:-1] << _BITS) | line[2:]
        return np.unique(keys, return_counts=True)

    def _letter(self, code: int) -> np.ndarray:
        found = self.letters.get(code)
        if found is None:
            rng = np.random.Generator(np.random.PCG64([self.seed, code]))
            found = self.letters[code] = (rng.integers(0, 2, self.dims) * 2 - 1).astype(np.float32)
        return found

    def _row(self, key: int) -> int:
        row = self.rows.get(key)
        if row is None:
            mask = (1 << int(_BITS)) - 1
            a, b, c = key >> 2 * int(_BITS), key >> int(_BITS) & mask, key & mask
            row = self.rows[key] = len(self.rows)
            self.matrix[row] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
        return row

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors."""
        out = np.zeros(self.dims)
        for start in range(0, len(keys), 4096):
            part = keys[start : start + 4096].tolist()
            if len(self.rows) + len(part) > _KEPT:
                self.rows.clear()
            rows = [self._row(k) for k in part]
            out += counts[start : start + 4096].astype(np.float32) @ self.matrix[rows]
        return out


def _learn(text_col: str, lang_col: str, dims: int, seed: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _Space(dims, seed), {}
        for batch in slices(batches, text_col, 4 << 20):
            held = defaultdict(list)
            column = lambda c, b=batch: b.column(b.schema.get_field_index(c)).to_pylist()
            for text, lang in zip(column(text_col), column(lang_col), strict=True):
                held[lang].append(space.trigrams(text))
            for lang, found in held.items():
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([c for _, c in found]), len(keys))
                sums[lang] = sums.get(lang, 0) + space.bundle(keys, counts)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang], "profile": pa.array([np.rint(v).astype(np.int64)], pa.list_(pa.int64()))}
            )

    return learn


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMS, seed: int = SEED
) -> dict[str, np.ndarray]:
    """Prototype of every language in ``docs``."""
    told = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    rows = (
        told.mapInArrow(giving_back(_learn("text", "lang", dims, seed)), "lang string, profile array<bigint>")
        .select("lang", F.posexplode("profile").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .collect()
    )
    out: dict[str, np.ndarray] = {}
    for lang, i, x in rows:
        out.setdefault(lang, np.zeros(dims))[i] = x
    return {lang: v for lang, v in sorted(out.items()) if v.any()}


def _guess(model, text_col: str, names: tuple[str, str], dims: int, seed: int, letterless: str | None):
    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _Space(dims, seed)
        langs = list(model.value)
        profiles = np.array([v / np.linalg.norm(v) for v in model.value.values()]).reshape(-1, dims)
        for batch in slices(batches, text_col, 4 << 20):
            found, scores = [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                keys, counts = space.trigrams(text)
                best, score = UNKNOWN if len(keys) else letterless, 0.0
                if len(keys) and langs:
                    v = space.bundle(keys, counts)
                    cosines = profiles @ v / max(np.linalg.norm(v), 1e-9)
                    k = int(np.argmax(cosines))
                    best, score = langs[k], float(min(1.0, max(0.0, cosines[k])))
                found.append(best)
                scores.append(score)
            fields, arrays = batch.schema.names, list(batch.columns)
            arrays[fields.index(names[0])] = pa.array(found, pa.string())
            arrays[fields.index(names[1])] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays(arrays, names=fields)

    return guess


def predict(
    docs: DataFrame,
    model: dict[str, np.ndarray],
    text_col: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
    seed: int = SEED,
    letterless: str | None = UNKNOWN,
) -> DataFrame:
    """``docs`` with the language (``letterless`` for texts without letters) and the cosine to its prototype added."""
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns exist already: {names}; name others")
    dims = len(next(iter(model.values()))) if model else DIMS
    out = docs.withColumns({names[0]: F.lit(None).cast("string"), names[1]: F.lit(None).cast("double")})
    held = docs.sparkSession.sparkContext.broadcast(model)
    return out.mapInArrow(giving_back(_guess(held, text_col, names, dims, seed, letterless)), out.schema)


def training(docs: DataFrame, doc_id: Column | None = None) -> DataFrame:
    """The documents that may teach: three folds of four."""
    return docs.where(fold(F.col("doc_id") if doc_id is None else doc_id, 4) != 2)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose text has no letter, whatever could be learned; columns as they were."""
    names = (free_name(docs, "lang_pred"), free_name(docs, "score"))
    model = fit(training(docs.select("doc_id", "text", "lang")))
    found = predict(docs, model, names=names, letterless=None)
    return found.where(F.col(names[0]).isNotNull()).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Every document with its fold, language and cosine."""
    model = fit(training(docs.select("doc_id", "text", "lang")))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
