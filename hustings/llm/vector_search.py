"""Exact top-k search by blocks, best blocks first.

Vectors of whole numbers are put in an order in which neighbours are alike, cut
into segments of ``SEGMENT`` rows, and a segment into blocks of ``BLOCK`` rows.
A component is two terms, its positive and its negative part; a block knows the
largest value of each term, so for a query the summed term maxima bound the score
of every row of the block from above. A query visits the blocks of a segment in
order of their bounds and scores them through the block's forward index (its rows
as a matrix) until the next bound falls below its kth score.

1. Rows are ordered by the most alike of a few pivots and by id, by a range
   partitioning, and stored as segments: ids, rows, term maxima of segment and
   blocks.
2. The queries of a segment search that segment first: their kth score there is
   a bound that later searches need only beat.
3. Query groups meet the segments' term maxima, which are broadcast in parts of at
   most ``BOUND_BYTES``, one pass per part; a query goes on to the segments whose
   bound reaches its kth score.
4. Segments and the queries that want them meet by segment, a large number of
   query groups dealt over several copies of the segment, so that a task holds one
   segment and a bounded number of queries. The best k of each query remain.

The pivots are fitted on a bounded sample (``PIVOTS`` rows of smallest id hash);
they decide the order only, never a result.

Cases: vectors that are null, empty, or hold null, non-finite or (scaled) 62-bit
components take no part, nor do rows without an id. A shorter vector counts as
filled up with zeros. A query never meets rows of its own id; several equal rows
of one query are one query, in whatever segments they lie; where the rows of one id
have different vectors, a candidate counts once, with its best score over them. Other
repeated rows are candidates each. Ties go to smaller ids. With fewer than k candidates all are returned; an empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 5
BLOCK = 64
SEGMENT = 1024
PIVOTS = 64
BOUND_BYTES = 32 << 20
#: Query groups that a task gathers for one segment.
GROUPS = 512
_LARGE = 2.0**62


def valid(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part, scaled and rounded down."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(F.lit(scale) * c))
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < _LARGE))
    return (
        vectors.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & (F.size(x) > 0) & fits)
        .select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), scaled.alias("v"))
    )


def _matrix(rows: list, dim: int) -> np.ndarray:
    if rows and all(len(r) == dim for r in rows):
        return np.array(rows, dtype=np.int64).reshape(len(rows), dim)
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where no sum can pass 2**53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2.0**53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima of every block for every query."""
    return products(np.maximum(q, 0), high) + products(np.minimum(q, 0), low)


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<i8").tobytes()


def _unpack(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(-1, dim)


def _segmenter(dim: int, pivots, segment: int, block: int):
    schema = "segment bigint, ids binary, rows binary, high binary, low binary, top_high binary, top_low binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, rows = TaskContext.get().partitionId(), 0, [], []

        def flush() -> pa.RecordBatch:
            x = _matrix(rows, dim)
            starts = range(0, len(x), block)
            high = np.array([x[i : i + block].max(axis=0) for i in starts])
            low = np.array([x[i : i + block].min(axis=0) for i in starts])
            values = [(part << 32) + seq, *map(_pack, (np.array(ids), x, high, low, high.max(axis=0), low.min(axis=0)))]
            names = ["segment", "ids", "rows", "high", "low", "top_high", "top_low"]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(vec_id)
                rows.append(v)
                if len(ids) == segment:
                    yield flush()
                    seq, ids, rows = seq + 1, [], []
        if ids:
            yield flush()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        norm = np.maximum(np.linalg.norm(p.astype(float), axis=1), 1)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1).to_pylist(), dim).astype(float)
                best = np.argmax(x @ p.T.astype(float) / norm, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32())], names=["vec_id", "v", "pivot"])

    return nearest, cut, schema


def index(rows: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Segments of the vectors (vec_id, v), stored, and the number of components."""
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOTS).collect()
    held = rows.sparkSession.sparkContext.broadcast(_matrix([r.v for r in sample], dim))
    nearest, cut, schema = _segmenter(dim, held, segment, block)
    if not sample:
        return rows.sparkSession.createDataFrame([], schema), dim
    ordered = (
        rows.mapInArrow(nearest, "vec_id bigint, v array<bigint>, pivot int")
        .repartitionByRange("pivot", "vec_id", F.xxhash64("v"))
        .sortWithinPartitions("pivot", "vec_id", "v")
    )
    return materialize(ordered.mapInArrow(cut, schema), "segments"), dim


class _Best:
    """The best k scores of each query so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in floors]

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        keep = np.flatnonzero(scores >= self.floors[i])
        if len(keep):
            best = sorted(self.found[i] + [(-int(scores[j]), int(ids[j]), int(at[j])) for j in keep])[: self.k]
            self.found[i] = best
            if len(best) == self.k:
                self.floors[i] = max(self.floors[i], -best[-1][0])


NO_FLOOR = np.iinfo(np.int64).min


def search(q_ids, q, floors, ids, x, high, low, k, size) -> _Best:
    """Block-at-a-time search of one segment for several queries."""
    best = _Best(floors, k)
    bound = bounds(q, high, low)
    order = np.argsort(-bound, axis=1, kind="stable")
    active = np.arange(len(q))
    for step in range(order.shape[1]):
        block = order[active, step]
        go = bound[active, block] >= best.floors[active]  # a row that ties with the kth may have a smaller id
        active, block = active[go], block[go]
        if not len(active):
            break
        for b in np.unique(block):
            rows = slice(b * size, (b + 1) * size)
            mine = active[block == b]
            scores = products(q[mine], x[rows])
            for i, line in zip(mine, scores, strict=True):
                other = np.flatnonzero(ids[rows] != q_ids[i])
                best.add(i, line[other], ids[rows][other], rows.start + other)
    return best


def _home(dim: int, k: int, every: int, block: int):
    """Each segment's queries with their kth score in it."""

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = np.frombuffer(row["ids"], "<i8"), _unpack(row["rows"], dim)
                mine = np.flatnonzero(ids % every == 0)
                if not len(mine):
                    continue
                pairs = sorted({(int(ids[i]), x[i].tobytes()): i for i in mine}.values())
                q_ids, q = ids[pairs], x[pairs]
                floors = np.full(len(q), NO_FLOOR)
                found = search(q_ids, q, floors, ids, x, _unpack(row["high"], dim), _unpack(row["low"], dim), k, block)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * len(q), pa.int64()),
                        pa.array(q_ids, pa.int64()),
                        pa.array([_pack(v) for v in q], pa.binary()),
                        pa.array(found.floors, pa.int64()),
                    ],
                    names=["origin", "query_id", "q", "floor"],
                )

    return home


def _distinct(queries: DataFrame) -> DataFrame:
    """Query groups (origin, queries): a query found in several segments stays with the
    first of them, with its best kth score."""
    once = queries.groupBy("query_id", "q").agg(F.min("origin").alias("origin"), F.max("floor").alias("floor"))
    # At most SEGMENT queries have one origin.
    return once.groupBy("origin").agg(F.collect_list(F.struct("query_id", "q", "floor")).alias("queries"))


def _wanted(dim: int, part):
    """The segments that each query has to visit."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, high, low = part.value
        for batch in batches:
            for row in batch.to_pylist():
                q = _unpack(b"".join(r["q"] for r in row["queries"]), dim)
                q_ids, floors = (np.array([r[c] for r in row["queries"]], np.int64) for c in ("query_id", "floor"))
                need = bounds(q, high, low) >= floors[:, None]
                at = np.flatnonzero(need.any(axis=0))
                for some in np.array_split(at, -(-len(at) // 64) or 1):
                    picks = [np.flatnonzero(need[:, s]) for s in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(segments[s]) for s in some], pa.int64()),
                            pa.array([row["origin"]] * len(some), pa.int64()),
                            pa.array([_pack(q_ids[p]) for p in picks], pa.binary()),
                            pa.array([_pack(q[p]) for p in picks], pa.binary()),
                            pa.array([_pack(floors[p]) for p in picks], pa.binary()),
                        ],
                        names=["segment", "origin", "q_ids", "q", "floors"],
                    )

    return wanted


def _visit(dim: int, k: int, block: int):
    names = ["query_id", "segment", "at", "vec_id", "score"]

    def visit(segment: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if segment.empty or queries.empty:
            return pd.DataFrame({c: [] for c in names}).astype("int64")
        row = segment.iloc[0]
        ids, x = np.frombuffer(row["ids"], "<i8"), _unpack(row["rows"], dim)
        q_ids = np.frombuffer(b"".join(queries["q_ids"]), "<i8")
        q = _unpack(b"".join(queries["q"]), dim)
        floors = np.frombuffer(b"".join(queries["floors"]), "<i8")
        best = search(q_ids, q, floors, ids, x, _unpack(row["high"], dim), _unpack(row["low"], dim), k, block)
        rows = [(int(q_ids[i]), int(row["segment"]), at, vec_id, -s) for i, found in enumerate(best.found) for s, vec_id, at in found]
        return pd.DataFrame(rows, columns=names).astype("int64")

    return visit


def top_k(
    vectors: DataFrame,
    every: int,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    bound_bytes: int = BOUND_BYTES,
    groups: int = GROUPS,
    segment: int = SEGMENT,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    segments, dim = index(valid(vectors, id_col, vector_col, scale), segment, block)
    group = "origin bigint, q_ids binary, q binary, floors binary"
    home = segments.select("segment", "ids", "rows", "high", "low").mapInArrow(
        _home(dim, k, every, block), "origin bigint, query_id bigint, q binary, floor bigint"
    )
    queries = materialize(_distinct(home), "queries")
    size = segments.count()
    parts = max(1, -(-size * 16 * dim // bound_bytes))
    wants = None
    for p in range(parts):
        some = segments if parts == 1 else segments.where(F.pmod(F.xxhash64("segment"), F.lit(parts)) == p)
        rows = some.select("segment", "top_high", "top_low").orderBy("segment").collect()
        # At most about bound_bytes: one row of term maxima per segment.
        high, low = (_unpack(b"".join(column), dim) for column in ([r.top_high for r in rows], [r.top_low for r in rows]))
        held = spark.sparkContext.broadcast(([r.segment for r in rows], high, low))
        found = queries.mapInArrow(_wanted(dim, held), f"segment bigint, {group}")
        wants = found if wants is None else wants.unionByName(found)
    copies = max(1, -(-queries.count() // groups))
    salt: Column = F.pmod(F.xxhash64("origin"), F.lit(copies))
    every_copy = F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))
    left = segments.withColumn("copy", F.explode(every_copy))
    visits = (
        left.groupBy("segment", "copy")
        .cogroup(wants.withColumn("copy", salt.cast("bigint")).groupBy("segment", "copy"))
        .applyInPandas(_visit(dim, k, block), "query_id bigint, segment bigint, at bigint, vec_id bigint, score bigint")
    )
    # The vectors of one id may have found the same row.
    once = visits.groupBy("query_id", "segment", "at").agg(F.min("vec_id").alias("vec_id"), F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def digest(vectors: DataFrame) -> DataFrame:
    """The five best rows for every row whose id is divisible by 50."""
    return top_k(vectors.select("vec_id", "embedding"), every=50)


ORACLE = """
with v as (
  select row_number() over () as r, vec_id,
    list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), d as (select r, vec_id, unnest(x) as x, unnest(range(len(x))) as i from v
), s as (
  select q.vec_id as query_id, c.r, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from d q join d c on q.i = c.i and c.vec_id <> q.vec_id
  where q.vec_id % 50 = 0 group by q.vec_id, c.r, c.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 5
"""
