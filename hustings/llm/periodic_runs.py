"""Periodic runs of words: find stretches that repeat themselves, and collapse them.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal) and at least ``max(least, exponent * q)`` words that no
neighbouring word extends with the same period. Its words after the first ``q``
are dropped by :func:`collapsed`.

Two places ``i < j`` whose words agree for exactly ``L`` words, and differ just
before, are a maximal pair; the stretch from ``i`` to the end of the second one
then has the period ``j - i`` and cannot be extended. So the maximal pairs with
``L >= (exponent - 1) * (j - i)`` and ``L + j - i >= least`` are exactly the runs,
each once per multiple of its smallest period; the least distance of a stretch
is that period.

Pairs come from the tree of intervals of common prefixes over the sorted
suffixes of a document, walked bottom-up: an interval keeps the list of its
places by position, each with its class (the word to its left); when a child
joins, the smaller list goes into the larger, and each place meets its nearest
neighbours there, unless they are of one class. Neighbours are enough: a place between the
two beginnings of a run with the same prefix would give it a smaller period.
So a list of n places costs n log n, and no group of equal words is paired up.
Only intervals long enough for a run (five words by default) are walked, so
suffixes whose first words occur once are sorted away before.

Every document is worked on by itself where it lies: there is no shuffle. A
task holds about 8 MB of text at a time, or one text.

Cases: a null, empty or blank text has no words and no runs, and collapses to
the empty text. Repeated rows each get their row. An empty table gives an empty
result. A null id counts as the empty text in :func:`digest`. Extra columns pass
through :func:`find` and :func:`collapsed`; added names step aside for them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, free_name, ship, slices

EXPONENT, LEAST = 4, 6
_SLICE = 8 << 20
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RUN_SQL = "array<struct<start:bigint,length:bigint,period:bigint>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = r"[\x20\x09-\x0D]+"


def shortest_prefix(exponent: int, least: int) -> int:
    """The fewest words in which two places one period apart agree, over all periods."""
    return min(max((exponent - 1) * d, least - d) for d in range(1, least + 1))


class _Suffixes:
    """The words of several documents as numbers, one end mark after each document."""

    def __init__(self, docs: list[list[bytes]]):
        known: dict[bytes, int] = {}
        codes: list[int] = []
        for doc in docs:
            codes += [known.setdefault(w, len(known)) for w in doc]
            codes.append(-1)
        self.words = np.array(codes, dtype=np.int64)
        lengths = np.array([len(d) + 1 for d in docs], dtype=np.int64)
        self.ends = np.cumsum(lengths) - 1
        self.doc = np.repeat(np.arange(len(docs)), lengths)
        self.words[self.ends] = -1 - np.arange(len(docs))  # no two ends are equal

    def repeated(self, g: int) -> np.ndarray:
        """Documents in which some ``g`` consecutive words (by their hash) occur twice."""
        n = len(self.words) - g + 1
        if n < 2:
            return np.zeros(0, dtype=np.int64)
        coded = self.words.astype(np.uint64) * _MIX
        coded ^= coded >> np.uint64(29)
        h = self.doc[:n].astype(np.uint64)
        for j in range(g):
            h = h * _MIX + coded[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[g - 1 :])
        at = at[self.words[at + g - 1] >= 0]
        order = at[np.argsort(h[at])]
        same = h[order[1:]] == h[order[:-1]]
        return np.unique(self.doc[order[1:][same]])

    def sorted_groups(self, g: int) -> Iterator[tuple[int, list[list[int]]]]:
        """Per document the places whose first ``g`` words occur again, grouped by them, in suffix order."""
        ends = self.ends[self.doc]
        here = np.arange(len(self.words))
        rank = np.unique(self.words, return_inverse=True)[1].astype(np.int64)
        base = int(rank.max()) + 1
        first, seen = self.doc * base + rank, rank
        for j in range(1, g):
            first = np.unique(first, return_inverse=True)[1].astype(np.int64) * base + seen[np.minimum(here + j, ends)]
        # The rank of a group is the place of its first member in the whole order, so that it can be refined.
        values, group, sizes = np.unique(first, return_inverse=True, return_counts=True)
        rank = (np.cumsum(sizes) - sizes)[group]
        active = np.flatnonzero(sizes[group] > 1)
        groups, members = rank[active], active
        width, k = len(here) + 1, g
        while len(active):
            key = rank[active] * width + rank[np.minimum(active + k, ends[active])]
            order = np.argsort(key, kind="stable")
            active, key = active[order], key[order]
            old = key // width
            at = np.arange(len(key))
            new_old = np.concatenate(([True], old[1:] != old[:-1]))
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            start_old = np.maximum.accumulate(np.where(new_old, at, 0))
            start_key = np.maximum.accumulate(np.where(new_key, at, 0))
            rank[active] = old + start_key - start_old
            tied = ~new_key | np.concatenate((~new_key[1:], [False]))
            active, k = active[tied], 2 * k
        order = np.argsort(rank[members], kind="stable")
        members, groups = members[order], groups[order]
        cuts = np.flatnonzero(groups[1:] != groups[:-1]) + 1
        parts = [p.tolist() for p in np.split(members, cuts)] if len(members) else []
        start = 0
        while start < len(parts):  # the order is by document first
            doc = int(self.doc[parts[start][0]])
            stop = start
            while stop < len(parts) and self.doc[parts[stop][0]] == doc:
                stop += 1
            yield doc, parts[start:stop]
            start = stop


def _prefixes(words: list[int], groups: list[list[int]], g: int, base: int) -> dict[int, int]:
    """For each place that follows another one in its group, the number of words they share."""
    before = {here: prev for group in groups for prev, here in zip(group, group[1:])}
    shared: dict[int, int] = {}
    last, h = -2, 0
    for here in sorted(before):
        # One place further on, at most one word less is shared.
        h = max(g, h - 1) if here == last + 1 else g
        a, b = here - base, before[here] - base
        while words[a + h] == words[b + h]:
            h += 1
        shared[here], last = h, here
    return shared


def _document_runs(
    words: list[int], groups: list[list[int]], base: int, g: int, exponent: int, least: int
) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one document whose places begin at ``base``."""
    shared = _prefixes(words, groups, g, base)
    found: dict[tuple[int, int], int] = {}
    factor = exponent - 1

    def meet(i: int, j: int, length: int) -> None:
        distance = j - i
        if factor * distance > length or distance + length < least:
            return
        if i > base and words[i - base - 1] == words[j - base - 1]:
            return  # of one class: the pair goes on to the left
        key = (i - base, length + distance)
        if distance < found.get(key, distance + 1):
            found[key] = distance

    def joined(a: list[int], b: list[int], length: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for x in b:
            k = bisect_left(a, x)
            if k:
                meet(a[k - 1], x, length)
            if k < len(a):
                meet(x, a[k], length)
        if len(b) > 8:
            a.extend(b)
            a.sort()  # two sorted stretches: merged in one pass
        else:
            for x in b:
                insort(a, x)
        return a

    for group in groups:
        if len(group) == 2:
            i, j = sorted(group)
            meet(i, j, shared[group[1]])
            continue
        open_intervals: list[tuple[int, list[int]]] = []
        last = [group[0]]
        for here in [*group[1:], None]:
            length = shared[here] if here is not None else 0
            while open_intervals and open_intervals[-1][0] > length:
                own, places = open_intervals.pop()
                last = joined(places, last, own)
            if open_intervals and open_intervals[-1][0] == length:
                open_intervals[-1] = (length, joined(open_intervals[-1][1], last, length))
            else:
                open_intervals.append((length, last))
            last = [here]
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of(docs: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not docs:
        return out
    g = shortest_prefix(exponent, least)
    every = _Suffixes(docs)
    with_repeats = every.repeated(g).tolist()
    if not with_repeats:
        return out
    some = _Suffixes([docs[k] for k in with_repeats])
    for k, groups in some.sorted_groups(g):
        stop = int(some.ends[k])
        base = int(some.ends[k - 1]) + 1 if k else 0
        words = some.words[base : stop + 1].tolist()
        found = _document_runs(words, groups, base, g, exponent, least)
        out[with_repeats[k]] = sorted(found, key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run's repetitions."""
    if not runs:
        return words
    kept, at = [], 0
    for start, stop in sorted((s + p, s + n) for s, n, p in runs):
        kept += words[at : max(at, start)]
        at = max(at, stop)
    return kept + words[at:]


def _finder(text_col: str, names: dict[str, str], exponent: int, least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, _SLICE):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            docs = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
            runs = runs_of(docs, exponent, least)
            new = {
                names["n_words"]: pa.array([len(d) for d in docs], pa.int64()),
                names["runs"]: pa.array(
                    [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], _RUN
                ),
                names["collapsed"]: pa.array(
                    [b" ".join(collapse(d, r)).decode() for d, r in zip(docs, runs, strict=True)], pa.string()
                ),
            }
            columns = [*batch.columns, *new.values()]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *new])

    return scan


def find(
    docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the runs of its texts added, and the names of the added columns:
    ``n_words``, ``runs`` (by start, then period; words count from 0) and ``collapsed``
    (the text without repetitions, words joined by one space)."""
    if exponent < 2 or least < 2:
        raise ValueError("a run repeats at least once: exponent and least start at 2")
    ship(docs.sparkSession)
    names = {c: free_name(docs, c) for c in ("n_words", "runs", "collapsed")}
    added = f"`{names['n_words']}` bigint, `{names['runs']}` {_RUN_SQL}, `{names['collapsed']}` string"
    empty = docs.sparkSession.createDataFrame([], added).schema
    schema = type(empty)([*docs.schema.fields, *empty.fields])
    return docs.mapInArrow(_finder(text_col, names, exponent, least), schema), names


def collapsed(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repetitions of every run taken out of its text; a null text stays null,
    a text without runs stays as it was."""
    found, names = find(docs, text_col, **options)
    text = F.when(F.size(names["runs"]) > 0, F.col(names["collapsed"])).otherwise(F.col(f"`{text_col}`"))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def planted(doc_id: Column, text: Column) -> Column:
    """The texts of :func:`digest`: of a tenth of the ids, the words from some place on repeat a stretch."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    stretch = F.slice(words, a + 1, p)
    repeats = F.slice(F.flatten(F.array_repeat(stretch, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeats), " ")
    return F.when((fold(doc_id, 10) == 0) & (n > 0), periodic).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    given = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found, names = find(given)
    runs, collapsed_text = F.col(names["runs"]), F.col(names["collapsed"])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    longest = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    best = found.withColumn(names["n_words"], longest)
    top = F.col(names["n_words"])
    return best.select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        (-top["col2"]).alias("start"),
        top["length"].alias("length"),
        (-top["col3"]).alias("period"),
        F.floor(1000 * top["length"] / -top["col3"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n")))).cast("binary"), 256).alias(
            "runs_sha256"
        ),
        F.sha2(collapsed_text.cast("binary"), 256).alias("collapsed_sha256"),
    )
