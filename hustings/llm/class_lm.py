"""Brown class-based bigrams: exchange clustering and smoothed scores of texts.

The model: P(w | v) = k (1 - u) P(class w | class v) P(w | class w) + (1 - k) base(w),
where u (singletons / tokens) is the chance of an unknown word, ``base`` the add-half
unigram, transitions are smoothed by the class shares, and END, which closes every
text, is a word with a class of its own and the context of the first word.

Exchange: words begin in classes by their last two bytes. In each sweep, every
word weighs all classes with the class counts of the sweep before: by its left
neighbours' transitions into the class, the class's transitions into its right
neighbours, and its share of the class; it moves to the best. All words of the
training texts take part.

The vocabulary grows with the data, so no task holds it and none of it is broadcast.
The corpus is coded once into chunks with word numbers of their own, stored with the
chunk's words dealt by hash into buckets. A bucket holds a share of all words: it
adds up what chunks report of its words (counts, class neighbours), decides their
classes, and answers each chunk in the order in which the chunk listed them. Chunks
and buckets send packed messages, one per chunk and bucket, about as many bytes as
the chunk has different words; a frequent word is one entry per chunk. Chunk size is
fixed and the number of buckets grows with the text, so tasks stay bounded. Only
``CLASSES`` squared class counts and three sums reach the driver.

Cases: a null or empty text is END alone. Documents with null ids are in the fold of
the empty id. Repeated rows each count and are scored alike. Without any training
token every score is that of the base, 0. An empty table gives no rows. Extra columns
are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, slices, words_of

CLASSES = 64
SWEEPS = 2
CHUNK_BYTES = 16 << 20
KEPT_SHARE = 0.98  # k
PRIOR = 32.0  # weight of class shares in a transition
_SIDES = 2 * CLASSES
_MESSAGE = "kind string, bucket int, chunk bigint, data binary"
_NAMES = ["kind", "bucket", "chunk", "data"]


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _open(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Arrays of equal length that were squeezed together."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for k, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, k, n, at))
        at += n * size
    return out


def first_class(word: bytes) -> int:
    """Class by the last two bytes; 0 is END's."""
    return 1 + xxhash.xxh3_64_intdigest(word[-2:]) % (CLASSES - 1) if word else 0


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=_NAMES)


class _Chunk:
    """Coded texts with word numbers of their own. Number 0 is END."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, teaches: np.ndarray, buckets: np.ndarray):
        self.codes, self.lengths, self.teaches, self.buckets = codes, lengths, teaches, buckets
        self.order = np.argsort(buckets, kind="stable")  # words bucket by bucket
        self.names, starts = np.unique(buckets[self.order], return_index=True)
        self.cuts = [*starts.tolist(), len(buckets)]
        self.place = np.empty(len(buckets), dtype=np.int64)  # of a word in its bucket's list
        for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            self.place[self.order[a:b]] = np.arange(b - a)

    def training(self) -> np.ndarray:
        return self.codes[np.repeat(self.teaches, self.lengths)]

    def lists(self) -> Iterator[tuple[int, np.ndarray]]:
        """Buckets and the chunk's words in them, in the order of messages."""
        for name, a, b in zip(self.names, self.cuts[:-1], self.cuts[1:], strict=True):
            yield int(name), self.order[a:b]

    def neighbours(self, chunk: int, classes: np.ndarray) -> list[tuple]:
        """Messages of the classes left and right of each word, and the class pairs."""
        w = self.training().astype(np.int64)
        v = np.concatenate(([0], w[:-1])) if len(w) else w
        left = w * _SIDES + classes[v]
        right = v * _SIDES + CLASSES + classes[w]
        keys, counts = np.unique(np.concatenate((left, right)), return_counts=True)
        words, sides = keys // _SIDES, (keys % _SIDES).astype("u1")
        by = np.argsort(self.buckets[words], kind="stable")
        buckets = self.buckets[words[by]]
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1)) if len(by) else np.zeros(1, int)
        out = [
            ("near", int(buckets[a]), chunk, _squeeze(self.place[words[by[a:b]]].astype("<u4"), sides[by[a:b]], counts[by[a:b]].astype("<u4")))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        return [*out, ("pairs", -1, chunk, self.pairs(classes))]

    def pairs(self, classes: np.ndarray) -> bytes:
        w = classes[self.training()].astype(np.int64)
        v = np.concatenate(([0], w[:-1])) if len(w) else w
        return _squeeze(np.bincount(v * CLASSES + w, minlength=CLASSES * CLASSES).astype("<i8"))


def _code(n_buckets: int):
    """Code texts into chunks; report their words and first neighbours."""
    schema = pa.schema([*[(n, t) for n, t in zip(_NAMES, [pa.string(), pa.int32(), pa.int64(), pa.binary()], strict=True)],
                        ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0

        def begin():
            numbers: defaultdict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            return numbers, [], [], [], [0], numbers[b""]

        numbers, codes, ids, held, size, _ = begin()

        def end() -> Iterator[pa.RecordBatch]:
            chunk = (part << 24) + seq
            words = list(numbers)
            buckets = np.array([xxhash.xxh3_64_intdigest(w) % n_buckets for w in words], dtype=np.int64)
            lengths = np.array([len(c) for c in codes], dtype=np.int64)
            own = _Chunk(np.concatenate(codes), lengths, ~np.array(held), buckets)
            counts = np.bincount(own.training(), minlength=len(words)).astype("<u4")
            rows = [
                ("words", b, chunk, _squeeze(counts[at]) + b" " + b" ".join(words[i] for i in at.tolist())) for b, at in own.lists()
            ]
            first = np.array([first_class(w) for w in words])
            for m in range(0, len(rows), 64):
                yield full(rows[m : m + 64])
            yield full(own.neighbours(chunk, first))
            data = _squeeze(own.codes.astype("<u4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(
                    ("coded", None, chunk, data, ids, held, lengths.tolist()), schema.types, strict=True)], schema=schema)
            yield full([("dealt", None, chunk, _squeeze(buckets.astype("<u4")))])

        def full(rows: list[tuple]) -> pa.RecordBatch:
            none = [None] * len(rows)
            columns = [*zip(*rows, strict=True), none, none, none]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

        for batch in slices(batches, "text", 4 << 20):
            for doc_id, is_held, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = words_of(text)
                line = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words))
                codes.append(np.append(line, np.uint32(0)))
                ids.append(doc_id)
                held.append(is_held)
                size[0] += len(text or "") + 1
                if size[0] >= CHUNK_BYTES:
                    yield from end()
                    seq += 1
                    numbers, codes, ids, held, size, _ = begin()
        if ids:
            yield from end()

    return code


_CODED = f"{_MESSAGE}, ids array<bigint>, held array<boolean>, lengths array<int>"


def _words(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Counts and words of a message: a zstandard frame, a space, the words."""
    frame = zstandard.ZstdDecompressor().decompressobj()
    counts = np.frombuffer(frame.decompress(data), "<u4")
    return counts, frame.unused_data[1:].split(b" ")


def _number(bucket: pd.DataFrame) -> pd.DataFrame:
    """Number a bucket's words: their places for each chunk, their counts and first classes."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    bucket = bucket.sort_values("chunk")
    name, parts = int(bucket["bucket"].iloc[0]), []
    for chunk, data in zip(bucket["chunk"], bucket["data"], strict=True):
        counts, words = _words(data)
        parts.append((int(chunk), np.fromiter(map(numbers.__getitem__, words), dtype="<u4", count=len(words)), counts))
    total = np.zeros(len(numbers), dtype="<i8")
    for _, at, counts in parts:
        total[at] += counts
    first = np.array([first_class(w) for w in numbers], dtype="u1")
    rows = [("places", name, chunk, _squeeze(at)) for chunk, at, _ in parts]
    rows += [("state", name, None, _squeeze(total, first))]
    sums = np.array([total.sum(), (total > 0).sum(), (total == 1).sum()], dtype="<i8")
    return pd.DataFrame([*rows, ("sums", name, None, sums.tobytes())], columns=_NAMES)


def transitions(pairs: np.ndarray) -> np.ndarray:
    """P(class | class before), smoothed by the class shares."""
    share = pairs.sum(axis=0) / max(1, pairs.sum())
    return (pairs + PRIOR * share) / np.maximum(pairs.sum(axis=1, keepdims=True) + PRIOR, 1e-12)


def _exchange(pairs):
    """One bucket of a sweep: add up neighbours, move words, and answer the chunks."""

    def exchange(bucket: pd.DataFrame) -> pd.DataFrame:
        name = int(bucket["bucket"].iloc[0])
        kinds = {k: g for k, g in bucket.groupby("kind")}
        total, classes = _open(kinds["state"]["data"].iloc[0], "<i8", "u1")
        places = {int(c): _open(d, "<u4")[0] for c, d in zip(kinds["places"]["chunk"], kinds["places"]["data"], strict=True)}
        if "near" in kinds:
            keys, counts = [], []
            for chunk, data in zip(kinds["near"]["chunk"], kinds["near"]["data"], strict=True):
                at, side, n = _open(data, "<u4", "u1", "<u4")
                keys.append(places[int(chunk)][at].astype(np.int64) * _SIDES + side)
                counts.append(n)
            keys, counts = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(keys, kind="stable")
            classes = _moved(total, classes, keys[order], counts[order], pairs.value)
        rows = [("answer", name, chunk, _squeeze(total[at].astype("<i8"), classes[at])) for chunk, at in sorted(places.items())]
        rows.append(("state", name, None, _squeeze(total, classes)))
        members = np.bincount(classes, total, CLASSES).astype("<i8")
        return pd.DataFrame([*rows, ("members", name, None, members.tobytes())], columns=_NAMES)

    return exchange


def _moved(total, classes, keys, counts, pairs) -> np.ndarray:
    """The best class of every known word but END; ``keys`` are sorted."""
    step = np.log(np.maximum(transitions(pairs), 1e-12))
    inside = np.log(np.maximum(pairs.sum(axis=0), 1.0))
    weights = np.vstack((step, step.T))  # left neighbours into the class, the class into right ones
    moved = classes.copy()
    for low in range(0, len(total), 4096):
        high = min(len(total), low + 4096)
        a, b = np.searchsorted(keys, [low * _SIDES, high * _SIDES])
        near = np.bincount(keys[a:b] - low * _SIDES, counts[a:b], (high - low) * _SIDES).reshape(-1, _SIDES)
        score = near @ weights - total[low:high, None] * inside
        score[:, 0] = -np.inf
        best = np.argmax(score, axis=1)
        free = (total[low:high] > 0) & (classes[low:high] > 0)
        moved[low:high] = np.where(free, best, classes[low:high])
    return moved


def _rows_of(chunk: pd.DataFrame):
    kinds = {k: g for k, g in chunk.groupby("kind")}
    coded, answers = kinds["coded"].iloc[0], kinds["answer"].sort_values("bucket")
    (codes,), (buckets,) = _open(coded["data"], "<u4"), _open(kinds["dealt"]["data"].iloc[0], "<u4")
    held = np.array(coded["held"], dtype=bool)
    own = _Chunk(codes, np.array(coded["lengths"], dtype=np.int64), ~held, buckets.astype(np.int64))
    found = [_open(d, "<i8", "u1") for d in answers["data"]]
    counts, classes = np.empty(len(buckets), np.int64), np.empty(len(buckets), np.int64)
    counts[own.order] = np.concatenate([f[0] for f in found])
    classes[own.order] = np.concatenate([f[1] for f in found])
    return int(coded["chunk"]), coded, held, own, counts, classes


def _report(neighbours: bool):
    def report(chunk: pd.DataFrame) -> pd.DataFrame:
        name, _, _, own, _, classes = _rows_of(chunk)
        rows = own.neighbours(name, classes) if neighbours else [("pairs", -1, name, own.pairs(classes))]
        return pd.DataFrame(rows, columns=_NAMES)

    return report


class Model:
    """Class counts and the three sums of the vocabulary."""

    def __init__(self, pairs: np.ndarray, members: np.ndarray, tokens: int, words: int, singles: int):
        self.steps, self.members, self.tokens, self.words = transitions(pairs), members, tokens, words
        self.unknown = min(0.5, max(singles, 0.5) / tokens) if tokens else 0.0
        self.share = KEPT_SHARE if tokens else 0.0

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.words + 1))

    def chances(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of every token, given the one before; the first follows END."""
        before = np.concatenate(([0], classes[:-1]))
        inside = counts / np.maximum(self.members[classes], 1)
        known = (1 - self.unknown) * self.steps[before, classes] * inside
        return self.share * np.where(counts > 0, known, self.unknown) + (1 - self.share) * self.base(counts)


def _score(model):
    def score(chunk: pd.DataFrame) -> pd.DataFrame:
        _, coded, held, own, counts, classes = _rows_of(chunk)
        m, n = model.value, counts[own.codes]
        starts = np.concatenate(([0], np.cumsum(own.lengths)[:-1]))
        add = lambda x: np.add.reduceat(x, starts)
        # A text ends with END, so that the next one's first word follows END too.
        return pd.DataFrame(
            {
                "doc_id": pd.array(coded["ids"], dtype="Int64"),
                "held_out": held,
                "n_tokens": own.lengths,
                "n_known": add((n > 0).astype(np.int64)),
                "base_score": add(np.log10(m.base(n))),
                "score": add(np.log10(m.chances(n, classes[own.codes]))),
            }
        )

    return score


def _summed(messages: DataFrame, kind: str, n: int) -> np.ndarray:
    """Sum of the arrays of ``n`` numbers in messages of a kind."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += _open(data, "<i8")[0] if kind == "pairs" else np.frombuffer(data, "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "x"])

    rows = messages.where(F.col("kind") == kind).select("data").mapInArrow(opened, "i bigint, x bigint")
    out = np.zeros(n, dtype=np.int64)
    for i, x in rows.groupBy("i").agg(F.sum("x")).collect():  # n numbers at most
        out[i] = x
    return out


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS) -> DataFrame:
    """Scores of all ``docs`` by a model of those that are not ``held_out``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    coded = materialize(rows.mapInArrow(_code(max(4, math.ceil(size / CHUNK_BYTES))), _CODED), "coded")
    of = lambda df, kind: df.where(F.col("kind") == kind).select(*_NAMES)
    numbered = materialize(of(coded, "words").groupBy("bucket").applyInPandas(_number, _MESSAGE), "numbered")
    tokens, words, singles = _summed(numbered, "sums", 3).tolist()
    chunks = coded.where("kind in ('coded', 'dealt')")
    state, near = of(numbered, "state"), coded
    for sweep in range(sweeps):
        pairs = spark.sparkContext.broadcast(_summed(near, "pairs", CLASSES**2).reshape(CLASSES, CLASSES))
        inbox = of(numbered, "places").unionByName(state).unionByName(of(near, "near"))
        moved = materialize(inbox.groupBy("bucket").applyInPandas(_exchange(pairs), _MESSAGE), "classes")
        state = of(moved, "state")
        asked = chunks.unionByName(of(moved, "answer"), allowMissingColumns=True)
        # After the last sweep only the class pairs are counted anew.
        near = materialize(asked.groupBy("chunk").applyInPandas(_report(sweep + 1 < sweeps), _MESSAGE), "neighbours")
    pairs = _summed(near, "pairs", CLASSES**2).reshape(CLASSES, CLASSES)
    model = Model(pairs, _summed(moved, "members", CLASSES), tokens, words, singles)
    found = asked.groupBy("chunk").applyInPandas(
        _score(spark.sparkContext.broadcast(model)),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return found.withColumn("train_tokens", F.lit(tokens).cast("bigint"))


def digest(docs: DataFrame) -> DataFrame:
    """Every document scored; one fold of five is held out."""
    return score(docs.select("doc_id", "text"), fold(F.col("doc_id"), 5) == 1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
