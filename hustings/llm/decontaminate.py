"""Benchmark decontamination: find windows of benchmark items in documents.

The windows of the benchmark (13 consecutive words; an item of fewer words is
one window) go to every task as a hash set; documents are scanned in place, so
no document is shuffled. A task maps words to benchmark word numbers, hashes
the windows that consist of benchmark words only, and verifies each hit word by
word before it counts.

The set is broadcast only up to ``part_bytes`` of benchmark text. A larger
benchmark is dealt into parts of that size, and the documents, stored with the
hits so far, are scanned once per part.

Cases: a null or empty text has no words and no hits. Items whose id or text
is null, or that have no words, are not looked for; several rows with the same
item id are one item. Repeated documents each get their row. An empty table
gives an empty result. Extra columns pass through untouched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, giving_back, materialize, slices, text_words

WINDOW = 13
PART_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)

FOUND = "n_words bigint, n_hit bigint, spans array<struct<first:int,last:int>>, item_ids array<bigint>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


class _Windows:
    """Windows of benchmark items by length, with the items they stand in."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.words: dict[bytes, int] = {}
        held: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = tuple(self.words.setdefault(w, len(self.words) + 1) for w in text_words(text))
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                held[n][ids[i : i + n]].add(item)
        self.by_length = {}
        for n, windows in held.items():
            keys = np.array(list(windows), dtype=np.uint64).reshape(-1, n)
            hashes = self._hash(keys.T)
            exact: dict[int, list[tuple[tuple[int, ...], set[int]]]] = defaultdict(list)
            for h, (ids, found) in zip(hashes.tolist(), windows.items(), strict=True):
                exact[h].append((ids, found))
            self.by_length[n] = (np.unique(hashes), exact)

    @staticmethod
    def _hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = h * _STEP + c
        return h

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[int]]]:
        """Start, length and items of every window that occurs in the word numbers (0: no benchmark word)."""
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for n, (hashes, exact) in self.by_length.items():
            starts = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else []
            if not len(starts):
                continue
            h = self._hash([ids[starts + j].astype(np.uint64) for j in range(n)])
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for k in np.flatnonzero(hashes[at] == h):
                start = int(starts[k])
                own = tuple(ids[start : start + n].tolist())
                for ids_of, items in exact[int(h[k])]:
                    if ids_of == own:
                        yield start, n, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _scanner(items, text_col: str, names: dict[str, str], window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Windows(items.value, window)
        for batch in slices(batches, text_col, 8 << 20):
            column = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            docs = [text_words(t) for t in column(text_col).to_pylist()]
            # All documents in one line, with a word of no item between them.
            ends = np.cumsum([len(d) + 1 for d in docs])
            ids = np.zeros(int(ends[-1]), dtype=np.int64)
            start = 0
            for d in docs:
                ids[start : start + len(d)] = [index.words.get(w, 0) for w in d]
                start += len(d) + 1
            hits, found = defaultdict(list), defaultdict(set)
            for first, n, items_of in index.scan(ids):
                doc = int(np.searchsorted(ends, first, side="right"))
                base = int(ends[doc - 1]) if doc else 0
                hits[doc].append((first - base, first - base + n - 1))
                found[doc] |= items_of
            old_spans, old_items = column(names["spans"]).to_pylist(), column(names["item_ids"]).to_pylist()
            spans = [
                _merge(hits[i] + [(s["first"], s["last"]) for s in old]) if i in hits or old else []
                for i, old in enumerate(old_spans)
            ]
            new = {
                "n_words": pa.array([len(d) for d in docs], pa.int64()),
                "n_hit": pa.array([sum(b - a + 1 for a, b in s) for s in spans], pa.int64()),
                "spans": pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], _SPANS),
                "item_ids": pa.array(
                    [sorted(found[i] | set(old)) if i in found or old else [] for i, old in enumerate(old_items)],
                    pa.list_(pa.int64()),
                ),
            }
            fields = batch.schema.names
            arrays = list(batch.columns)
            for name, values in new.items():
                arrays[fields.index(names[name])] = values
            yield pa.RecordBatch.from_arrays(arrays, names=fields)

    return scan


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the hits added, and the names of the added columns.

    Added: ``n_words``, ``n_hit`` (words inside any occurrence), ``spans`` (merged
    runs of hit words, numbered from 0, ends included) and ``item_ids``.
    """
    spark = docs.sparkSession
    names = {c: free_name(docs, c) for c in ("n_words", "n_hit", "spans", "item_ids")}
    empty = {
        names["n_words"]: F.lit(0).cast("bigint"),
        names["n_hit"]: F.lit(0).cast("bigint"),
        names["spans"]: F.array().cast("array<struct<first:int,last:int>>"),
        names["item_ids"]: F.array().cast("array<bigint>"),
    }
    out = docs.withColumns(empty)
    items = benchmark.select(
        F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("words")
    ).where("item is not null and words is not null")
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    for k in range(parts):
        part = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k)
        if k:
            out = materialize(out, "scanned")
        # At most about part_bytes of text: checked above.
        held = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        out = out.mapInArrow(giving_back(_scanner(held, text_col, names, window)), out.schema)
    return out, names


def is_contaminated(n_hit, n_words):
    """Some hit, and one word in twenty or more is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents, columns as they were."""
    found, names = find(docs, benchmark, text_col, **options)
    hit = is_contaminated(F.col(names["n_hit"]), F.col(names["n_words"]))
    return found.where(~hit).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: word and hit counts, the items found and the verdict."""
    found, names = find(docs.select("doc_id", "text"), benchmark)
    items = F.array_sort(F.transform(names["item_ids"], lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        F.col(names["n_words"]).alias("n_words"),
        F.col(names["n_hit"]).alias("n_hit"),
        F.size(names["item_ids"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col(names["n_hit"]), F.col(names["n_words"])).alias("contaminated"),
    )


#: The same by joining window texts.
ORACLE = r"""
with low as (
  select doc_id, row_number() over () as r,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents
), item as (
  select item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null and text is not null
), wins as (
  select distinct item_id, least(13, len(w)) as n,
    array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') as win
  from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from item where len(w) > 0)
), places as (
  select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from low, (select distinct n from wins) where len(w) >= n)
), hit as (
  select r, p.n, p.i, item_id from places p join wins using (n, win)
), words as (
  select r, count(distinct pos) as n_hit from (
    select r, unnest(range(i, i + n)) as pos from (select distinct r, n, i from hit)) group by r
), items as (
  select r, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as sha
  from (select distinct r, cast(item_id as varchar) as id from hit) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(sha, sha256('')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from low left join words using (r) left join items using (r)
"""
