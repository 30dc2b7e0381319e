"""N-gram Jaccard self-join by prefix trees, and the groups it links.

A document's set is its different word n-grams, as 58-bit hashes in one global order:
n-grams that stand in few documents first, then by hash. Two documents link when the Jaccard similarity of their
sets is at least ``percent`` / 100. Every link between different sets is found or
implied: the result is the connected groups, without listing pairs inside them.

1. Texts are read once for a 128-bit digest of each set, and stored in packed chunks. Rows of
   equal sets are one class, found by an aggregation that combines below the shuffle.
2. Chunks send their n-grams to hashed buckets in packed messages; buckets count the
   documents of each and answer with its rank, the logarithm of that number (about one n-gram
   in 64 shares its key, and so its rank, with another). Of each class,
   the first n - ceil(t n) + 1 elements in that order (two linked sets share one)
   are posted, but for those of one document, which link nothing. Postings of one element form a group; groups of equal members (by two
   xor digests and their number) are kept once, groups of one are dropped. A group
   over ``BLOCK`` members is dealt into blocks that meet pairwise.
3. A task compares a group's members by length and by parity sketches, whose distance
   never exceeds the size of the symmetric difference: what they rule out cannot
   link. Of the pairs left it proposes a spanning forest, not all pairs.
4. Proposed pairs are verified: the members proposed to one class are put in a trie
   by their ordered sets, and the class's set walks it, sharing the overlap of common
   beginnings and leaving subtrees whose remaining lengths cannot reach the needed
   overlap. A class with many members is dealt over tasks. Only texts of proposed pairs
   travel: a bitmap of bounded size tells the others before the shuffle.
5. Where a proposed pair fails, all pairs of its groups that the sketches allow and
   that are not in one component yet are verified too. So no link is lost.
6. Components are labelled by rounds of least neighbours and pointer jumping, each
   stored in the shared folder. Nothing but counts reaches the driver.

Cases: a null or empty text has an empty set and is linked with nothing; a text of
fewer words than n is one n-gram. Rows without an id get no component. Rows of the
same id take part each with its own set. Repeated rows are one class. An empty table
gives no rows. Extra columns pass through ``deduplicated``.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, giving_back, materialize, slices

BLOCK = 4096
#: Bytes of text in a chunk, n-grams in a bucket, and the most partitions that buckets are dealt to.
CHUNK_BYTES = 2 << 20
BUCKET = 1 << 21
MOST_PARTITIONS = 100_000
#: Members of a class verified in one trie.
TRIE = 256
#: Most bits of a sieve of ids (8 MB), and how many an id gets below that.
SIEVE_BITS = 1 << 26
BITS_AN_ID = 16
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LOW = np.uint64((1 << 58) - 1)


#: A class with more than one in so many of all rows is hot; there are fewer such classes than this.
HOT = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M3
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of 58-bit n-gram hashes.

    A word's hash is a polynomial over random numbers for its bytes, modulo 2**64,
    taken for all words of a text at once from running sums, and mixed.
    """

    def __init__(self, n: int):
        self.n = n
        self.bytes = np.random.Generator(np.random.PCG64(99)).integers(0, 2**64, 256, dtype=np.uint64)
        self.powers, self.inverses = self._tables(1 << 16)
        self.space = np.zeros(256, dtype=bool)
        self.space[[32, *range(9, 14)]] = True

    @staticmethod
    def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
        base, inverse = int(_M1), pow(int(_M1), -1, 1 << 64)
        return tuple(np.cumprod(np.array([1] + [x] * (n - 1), dtype=np.uint64)) for x in (base, inverse))

    def _piece(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8)
        if len(b) > len(self.powers):
            self.powers, self.inverses = self._tables(1 << len(b).bit_length())
        word = np.zeros(len(b) + 2, dtype=np.int8)
        word[1:-1] = ~self.space[b]
        edges = np.flatnonzero(np.diff(word))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(self.bytes[b] * self.powers[: len(b)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
        data, out, start = (text or "").encode("utf-8", "replace").lower(), [], 0
        while start < len(data):
            # Pieces of a long text end between words.
            end = min(len(data), start + (1 << 20))
            while end < len(data) and not self.space[data[end]]:
                end += 1
            out.append(self._piece(data[start:end]))
            start = end
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        h = self.words(text)
        if not len(h):
            return h
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            out = _mixed(out * _M1 + h[i : len(h) - n + 1 + i])
        out = np.sort(out & _LOW)
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def needed(a, b, percent: int):
    """Least overlap at which sets of sizes ``a`` and ``b`` link: o / (a + b - o) >= percent / 100."""
    return -((-percent * (a + b)) // (100 + percent))


def _digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def _survey(n: int, chunk_bytes: int):
    """Class digest and size of every document; and the documents in chunks, packed, for the passes to come."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, zstd = Shingler(n), zstandard.ZstdCompressor(level=3)
        ids, digests, texts, held = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            # Numbered at random; the table is stored before anything asks for a number.
            number = int.from_bytes(os.urandom(8), "big", signed=True)
            lengths, payload = [len(t) for t in texts], zstd.compress(b"".join(texts))
            values = [[None], [None], [None], [number], [ids[:]], [digests[:]], [lengths], [payload]]
            for column in (ids, digests, texts):
                column.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
        names = [part.split()[0] for part in _SURVEY.split(", ")]
        for batch in slices(batches, "text", 8 << 20):
            given, sets = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), []
            for doc_id, text in given:
                s = shingles(text)
                sets.append((doc_id, len(s), _digest(s) if len(s) else None))
                if len(s) and doc_id is not None:
                    data = text.encode("utf-8", "replace")
                    ids.append(doc_id)
                    digests.append(sets[-1][2])
                    texts.append(data)
                    held += len(data)
                    if held >= chunk_bytes:
                        yield chunk()
                        held = 0
            none = [None] * len(sets)
            values = [*zip(*sets, strict=True), none, none, none, none, none]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)
        if ids:
            yield chunk()

    return survey


_SURVEY = "doc_id bigint, n bigint, c binary, chunk bigint, ids array<bigint>, digests array<binary>, lengths array<bigint>, payload binary"


def _sets_of(row: dict, shingles: Shingler, zstd: zstandard.ZstdDecompressor) -> list[np.ndarray]:
    data, out, at = zstd.decompress(row["payload"]), [], 0
    for length in row["lengths"]:
        out.append(shingles(data[at : at + length].decode()))
        at += length
    return out


def key_bits(grams: int) -> int:
    """Bits of an n-gram that are counted: with 64 times as many keys as n-grams, about one n-gram in 64
    shares its key and gets the rank of both. All documents give it that rank, so no link is lost."""
    return min(48, max(32, grams.bit_length() + 6))


def _elements(sets: list[np.ndarray], bits: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a chunk, cut to ``bits`` bits, in order, and how many of its documents hold each."""
    return np.unique(np.concatenate(sets) >> np.uint64(58 - bits), return_counts=True)


def _edges(buckets: int, bits: int) -> np.ndarray:
    """Where each bucket of n-grams begins."""
    return np.array([-(-(b << bits) // buckets) for b in range(buckets)], dtype=np.uint64)


def _planes(x: np.ndarray) -> bytes:
    """Differences of ascending numbers, byte by byte, so that the high bytes, all zero, cost nothing."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _ask(n: int, buckets: int, bits: int):
    """Each chunk's n-grams as one packed message per bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, unzip, zstd, edges = Shingler(n), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), _edges(buckets, bits)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, counts = _elements(_sets_of(row, shingles, unzip), bits)
                cuts = np.append(np.searchsorted(keys, edges), len(keys)).tolist()
                sent = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sent, pa.int64()),
                        pa.array([row["chunk"]] * len(sent), pa.int64()),
                        pa.array([zstd.compress(_planes(keys[cuts[b] : cuts[b + 1]])) for b in sent], pa.binary()),
                        pa.array([zstd.compress(np.minimum(counts[cuts[b] : cuts[b + 1]], 255).astype(np.uint8).tobytes()) for b in sent], pa.binary()),
                    ],
                    names=["bucket", "chunk", "grams", "counts"],
                )

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each message the ranks of its n-grams: 0 for those of one document, else one more than
    the logarithm of the number of documents, 15 at most."""
    unzip, zstd = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    for table in _groups(batches, 1):
        edges = _bounds(table, 1)
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part = table.slice(low, high - low)
            messages = [_from_planes(unzip.decompress(g)) for g in part.column("grams").to_pylist()]
            counts = np.concatenate([np.frombuffer(unzip.decompress(c), np.uint8) for c in part.column("counts").to_pylist()])
            _, at = np.unique(np.concatenate(messages), return_inverse=True)
            held = np.bincount(at, counts)
            rank = np.where(held < 2, 0, np.minimum(15, 1 + np.floor(np.log2(np.maximum(held, 1))))).astype(np.uint8)[at]
            ends = np.cumsum([len(m) for m in messages])[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.column("chunk").to_pylist(), pa.int64()),
                    pa.array(part.column("bucket").to_pylist(), pa.int64()),
                    pa.array([zstd.compress(r.tobytes()) for r in np.split(rank, ends)], pa.binary()),
                ],
                names=["chunk", "bucket", "ranks"],
            )


def sketch(s: np.ndarray) -> bytes:
    """Parities of a set's elements over at least four bits each, a power of two in number."""
    bits = 1 << max(7, int(4 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s % bits).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _profile(n: int, percent: int, bits: int):
    """What is posted of the documents of a chunk: those of their prefix that stand in other documents, and a sketch."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, unzip = Shingler(n), zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sets = _sets_of(row, shingles, unzip)
                keys, _ = _elements(sets, bits)
                answers = sorted((a["bucket"], a["ranks"]) for a in row["answers"])
                ranks = np.concatenate([np.frombuffer(unzip.decompress(r), np.uint8) for _, r in answers]).astype(np.uint64)
                for doc_id, c, s in zip(row["ids"], row["digests"], sets, strict=True):
                    size = len(s)
                    if 100 * size < percent * (size + 1):
                        continue  # too small to link with another set
                    first = size - (-(-percent * size // 100)) + 1
                    rank = ranks[np.searchsorted(keys, s >> np.uint64(58 - bits))]
                    prefix = np.sort(s | rank << np.uint64(58))[:first]
                    posted = prefix[prefix > _LOW]
                    if len(posted):
                        out.append((doc_id, c, size, posted.view(np.int64).tolist(), sketch(s)))
            if out:
                types = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["doc_id", "c", "n", "prefix", "sketch"],
                )

    return profile


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of whole groups out of batches that are sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # The last group of a batch may go on in the next.
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in range(keys):
            v = batch.column(k).to_numpy(zero_copy_only=False)
            changed |= v[1:] != v[:-1]
        if held and any(held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        cut = int(np.flatnonzero(changed)[-1]) + 1 if changed.any() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: int) -> np.ndarray:
    changed = np.zeros(table.num_rows + 1, dtype=bool)
    changed[[0, -1]] = True
    for k in range(keys):
        v = table.column(k).to_numpy()
        changed[1:-1] |= v[1:] != v[:-1]
    return np.flatnonzero(changed)


def _far(sketches: list[bytes], i: int, others: np.ndarray, folded: dict[int, np.ndarray]) -> np.ndarray:
    """Sketch distances of one member to others; longer sketches are folded to the shortest."""
    width = min(len(s) for s in sketches)
    if width not in folded:
        rows = []
        for s in sketches:
            x = np.frombuffer(s, np.uint8)
            rows.append(np.bitwise_xor.reduce(x.reshape(-1, width), axis=0))
        folded[width] = np.array(rows).view(np.uint64)
    x = folded[width]
    return np.bitwise_count(x[others] ^ x[i]).sum(axis=1, dtype=np.int64)


def _forest(percent: int, every: bool):
    """Proposed pairs of each group. ``every``: all pairs not in one component yet, else a spanning forest."""

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            found: list[tuple[int, int, int]] = []
            edges = _bounds(table, 3)
            token = table.column("token").to_numpy()
            rid, size, comp = (table.column(c).to_numpy() for c in ("rid", "n", "comp"))
            sketches = table.column("sketch").to_pylist()
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                # By size, so that a member's partners stand in one stretch behind it.
                at = low + np.lexsort((rid[low:high], size[low:high]))
                r, n, c = rid[at], size[at], comp[at]
                if len(at) < 2 or (c == c[0]).all():
                    continue
                if len(at) == 2:
                    if 100 * n[0] < percent * n[1]:
                        continue
                mine, folded = [sketches[k] for k in at], {}
                ends = np.searchsorted(100 * n[0] * 0 + percent * n, 100 * n, side="right")
                root = list(range(len(at)))

                def find(x: int, root=root) -> int:
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                if not every:  # members of one component are joined already
                    first: dict[int, int] = {}
                    for k, label in enumerate(c.tolist()):
                        root[k] = first.setdefault(label, k)
                for i in range(len(at) - 1):
                    others = np.arange(i + 1, ends[i])
                    others = others[c[others] != c[i]]
                    if not len(others):
                        continue
                    most = n[others] + n[i] - 2 * needed(n[others], n[i], percent)
                    # Folding xors parities, so a folded distance is still a lower bound.
                    near = others[_far(mine, i, others, folded) <= most]
                    for j in near.tolist():
                        if not every:
                            a, b = find(i), find(j)
                            if a == b:
                                continue
                            root[max(a, b)] = min(a, b)
                        x, y = int(r[i]), int(r[j])
                        found.append((min(x, y), max(x, y), int(token[low])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b", "token"])

    return forest


class Trie:
    """Ordered sets by common beginnings. A node: its elements, children, sets that end there, least and greatest size."""

    def __init__(self, sets: list[tuple[int, np.ndarray]]):
        self.sets = sorted(((s.tolist(), name) for name, s in sets))
        self.root = self._node(0, len(self.sets), 0)

    def _node(self, low: int, high: int, depth: int):
        first, last = self.sets[low][0], self.sets[high - 1][0]
        end, most = depth, min(len(first), len(last))
        if first[depth:most] == last[depth:most]:
            end = most
        else:
            while first[end] == last[end]:
                end += 1
        at, ends = low, []
        while at < high and len(self.sets[at][0]) == end:
            ends.append(self.sets[at][1])
            at += 1
        children = []
        while at < high:
            element, start = self.sets[at][0][end], at
            while at < high and self.sets[at][0][end] == element:
                at += 1
            children.append(self._node(start, at, end))
        sizes = [c[3] for c in children] + [end] * bool(ends)
        sizes_up = [c[4] for c in children] + [end] * bool(ends)
        return first[depth:end], children, ends, min(sizes), max(sizes_up)

    def linked(self, s: np.ndarray, percent: int) -> list[int]:
        """Names of the sets that link with ``s``."""
        own, line, size, out = set(s.tolist()), s, len(s), []
        stack = [(self.root, 0, 0)]
        while stack:
            (elements, children, ends, least, greatest), depth, overlap = stack.pop()
            overlap += sum(map(own.__contains__, elements))
            depth += len(elements)
            # Of s, only elements after the last one passed can still be met.
            rest = size - int(np.searchsorted(line, np.uint64(elements[-1]), side="right")) if elements else size
            if overlap + min(rest, greatest - depth) < needed(size, least, percent):
                continue
            if ends and overlap >= needed(size, depth, percent):
                out += ends
            stack += [(c, depth, overlap) for c in children]
        return out


def _verify(n: int, percent: int):
    """Links among the pairs (a, member): per (a, salt), one row of a's text and rows of members' texts."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, zstd = Shingler(n), zstandard.ZstdDecompressor()
        for table in _groups(batches, 2):
            found = []
            edges = _bounds(table, 2)
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                rows = table.slice(low, high - low).to_pylist()
                a, sets = rows[0]["a"], {}
                for r in rows:
                    s = shingles(zstd.decompress(r["packed"]).decode())
                    if _digest(s) == r["c"]:  # else another text of the same id
                        sets[r["rid"]] = s
                members = [(name, s) for name, s in sets.items() if name != a]
                if a in sets and members:
                    found += [(a, b) for b in Trie(members).linked(sets[a], percent)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return verify


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zstd = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches, "text", 4 << 20):
        texts = [zstd.compress(t.encode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "packed"])


def components(edges: DataFrame) -> DataFrame:
    """(rid, comp): the least node that each node of the edges (a, b) reaches."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("rid")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["rid"]).groupBy(F.col("a").alias("rid")).agg(F.min("comp").alias("near"))
        )
        lower = labels.join(near, "rid").select("rid", "comp", F.least("comp", "near").alias("new"))
        # Jump: take the label of one's label, where it is lower.
        up = lower.select(F.col("rid").alias("up"), F.col("new").alias("upper"))
        jumped = materialize(
            lower.join(up, lower["new"] == up["up"], "left").select("rid", "comp", F.least("new", "upper").alias("new")), "labels"
        )
        labels = jumped.select("rid", F.col("new").alias("comp"))
        if not jumped.where("comp <> new").limit(1).count():
            return labels


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are not in one component."""
    out = pairs
    for end in ("a", "b"):
        label = labels.select(F.col("rid").alias(end), F.col("comp").alias(f"of_{end}"))
        out = out.join(label, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return out.where("of_a <> of_b").drop("of_a", "of_b")


def sifted(rows: DataFrame, wanted: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The rows whose key may be among those ``wanted``, told before they are shuffled.

    Hashes of the wanted keys are set in a bitmap, broadcast as a table of at most ``SIEVE_BITS``
    / 32,768 pieces of 4 KB, whatever the number of keys. No wanted row is lost; of the others a
    share passes, about one in ``BITS_AN_ID`` up to four million keys and more beyond, so an exact join has to follow.
    ``how="left_anti"`` gives the rest: rows whose key is certainly not wanted, which need no join.
    """
    bits = min(SIEVE_BITS, 1 << max(15, (BITS_AN_ID * wanted.count()).bit_length()))

    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name).cast(wanted.schema[key].dataType)), F.lit(bits)) + 1

    sieve = wanted.groupBy(F.bitmap_bucket_number(place(key)).alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(key))).alias("_bits")
    )
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.bitmap_bucket_number(place(key)) == F.col("_piece")
    return rows.join(F.broadcast(sieve), held & (F.getbit(byte, (at % 8).cast("int")) == 1), how).select(*rows.columns)


def discard(stored: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    files = stored.inputFiles()
    if files:
        spark = stored.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Join:
    """The join of a table's texts."""

    def __init__(self, docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text"):
        self.spark, self.n, self.percent = docs.sparkSession, n, percent
        self.docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        self.survey = materialize(self.docs.mapInArrow(giving_back(_survey(n, CHUNK_BYTES)), _SURVEY), "survey")
        self.rows = materialize(self.survey.where("n is not null").select("doc_id", "n", "c"), "rows")
        self.classes = materialize(
            self.rows.where("c is not null and doc_id is not null")
            .groupBy("c")
            .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")),
            "classes",
        )
        self.groups = self._join()

    def _ranked(self) -> DataFrame:
        """The chunks with the ranks of their n-grams, by true numbers of documents.

        Chunks send their n-grams to the buckets these fall in, and the buckets answer. A
        bucket holds about ``BUCKET`` n-grams, so their number grows with the data.
        """
        chunks = self.survey.where("chunk is not null").select("chunk", "ids", "digests", "lengths", "payload")
        grams = self.rows.agg(F.sum("n")).first()[0] or 0
        buckets, self.bits = max(1, -(-grams // BUCKET)), key_bits(grams)
        asked = chunks.mapInArrow(giving_back(_ask(self.n, buckets, self.bits)), "bucket bigint, chunk bigint, grams binary, counts binary")
        dealt = asked.repartition(min(buckets, MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket")
        answers = dealt.mapInArrow(giving_back(_answer), "chunk bigint, bucket bigint, ranks binary")
        of_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ranks")).alias("answers"))
        return chunks.join(of_chunk, "chunk")

    def _join(self) -> DataFrame:
        """(c, component): the least document of what each class is linked with."""
        ranked = self._ranked()
        profiles = (
            ranked.mapInArrow(giving_back(_profile(self.n, self.percent, self.bits)), "doc_id bigint, c binary, n bigint, prefix array<bigint>, sketch binary")
            .groupBy("c")
            .agg(F.min(F.struct("doc_id", "n", "prefix", "sketch")).alias("p"))
            .select("c", "p.*")
        )
        self.sets = materialize(profiles.withColumn("rid", F.monotonically_increasing_id()), "profiles")
        discard(self.survey)
        sizes = self.sets.select("rid", "n", "sketch")
        postings = self.sets.select("rid", F.explode("prefix").alias("token"))
        tokens = (
            postings.groupBy("token")
            .agg(
                F.count(F.lit(1)).alias("members"),
                F.bit_xor(F.xxhash64("rid")).alias("x"),
                F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("y"),
            )
            .where("members > 1")
            .groupBy("members", "x", "y")
            .agg(F.min("token").alias("token"))
        )
        tokens = materialize(tokens.select("token", F.ceil(F.col("members") / BLOCK).alias("blocks")), "tokens")
        kept = materialize(postings.join(tokens, "token"), "postings")
        mine = F.pmod(F.xxhash64("rid"), F.col("blocks"))
        meets = kept.withColumn("mine", mine).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        )
        placed = meets.select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rid")
        found = self._verified(self._proposed(placed.join(sizes, "rid").withColumn("comp", F.col("rid")), False), None, None)
        links = labels = None
        if found is not None:
            links, labels, failed, tried = found
        if found is not None and failed.limit(1).count():
            again = (
                placed.join(failed, "token")
                .join(sizes, "rid")
                .join(labels, "rid", "left")
                .withColumn("comp", F.coalesce("comp", "rid"))
            )
            more = self._verified(self._proposed(again, True), links, tried)
            if more is not None:
                links, labels = more[:2]
        if labels is None:
            return self.classes.select("c", F.col("least").alias("component"))
        named = self.sets.select("rid", "c").join(labels, "rid").join(self.classes, "c")
        least = named.groupBy("comp").agg(F.min("least").alias("component"))
        found = named.join(least, "comp").select("c", "component")
        return self.classes.join(found, "c", "left").select("c", F.coalesce("component", "least").alias("component"))

    def _proposed(self, members: DataFrame, every: bool) -> DataFrame:
        """(a, b, token) of pairs that may link."""
        keys = ["token", "i", "j"]
        dealt = members.select(*keys, "rid", "n", "comp", "sketch").repartition(*keys).sortWithinPartitions(*keys)
        return materialize(dealt.mapInArrow(giving_back(_forest(self.percent, every)), "a bigint, b bigint, token bigint"), "proposed")

    def _verified(self, proposed: DataFrame, known: DataFrame | None, tried: DataFrame | None):
        """Links found among proposed pairs with those ``known``, tokens of pairs that failed, and pairs tried.

        Of each member, one pair is verified first; a second one only if its ends are
        not in one component by then. So most sets travel once. None without pairs.
        """
        pairs = proposed.select("a", "b").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if not pairs.limit(1).count():
            return None
        first = materialize(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
        links = self._links(first)
        if known is not None:
            links = links.unionByName(known)
        labels = components(links)
        rest = materialize(apart(pairs.join(first, ["a", "b"], "left_anti"), labels), "rest")
        if rest.limit(1).count():
            links = links.unionByName(self._links(rest))
            labels = components(links)
        done = first.unionByName(rest)
        failed = materialize(apart(pairs.join(links.select("a", "b"), ["a", "b"], "left_anti"), labels), "failed")
        tokens = proposed.join(failed, ["a", "b"], "left_semi").select("token").distinct()
        return links, labels, materialize(tokens, "failed-tokens"), done

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(doc_id, packed): texts as they travel, packed to a third of their size and a quarter of their sets'.

        Those of ``wanted``, and a few more that the join to come drops.
        """
        known = sifted(self.docs.where("doc_id is not null and text is not null"), wanted, "doc_id")
        return known.mapInArrow(giving_back(_packed), "doc_id bigint, packed binary")

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets link, stored."""
        salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TRIE).alias("salts"))
        dealt = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts"))).select("a", "salt", "b")
        lines = dealt.select("a", "salt", F.col("b").alias("rid")).unionByName(
            dealt.select("a", "salt", F.col("a").alias("rid")).distinct()
        )
        wanted = materialize(lines.join(self.sets.select("rid", "c", "doc_id"), "rid"), "wanted")
        keyed = self._texts(wanted).join(wanted, "doc_id").select("a", "salt", "rid", "c", "packed")
        found = (
            keyed.repartition("a", "salt")
            .sortWithinPartitions("a", "salt")
            .mapInArrow(giving_back(_verify(self.n, self.percent)), "a bigint, b bigint")
        )
        return materialize(found.distinct(), "links")

    def labelled(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) of every row.

        Rows without words or an id need no group. Those of hot classes, fewer than ``HOT``, meet
        them by broadcast, so that the shuffle of the rest puts no such class into one task.
        """
        most = self.rows.count() / HOT
        hot = materialize(self.groups.join(self.classes.where(F.col("rows") > most).select("c"), "c"), "hot")
        grouped = F.col("c").isNotNull() & F.col("doc_id").isNotNull()
        rows = self.rows.where(grouped)
        of_hot = rows.join(F.broadcast(hot), "c").select("doc_id", "n", "component")
        of_rest = rows.join(F.broadcast(hot), "c", "left_anti").join(self.groups, "c", "left").select("doc_id", "n", "component")
        of_none = self.rows.where(~grouped).select("doc_id", "n", F.lit(None).cast("bigint").alias("component"))
        return of_hot.unionByName(of_rest).unionByName(of_none).select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )


def deduplicated(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, the one of least id; rows without an id or words all stay.

    Only texts that a bitmap of the dropped ids holds meet these in a join; the others are not shuffled.
    """
    found = Join(docs, n, percent).labelled().where("doc_id is not null")
    kept = (F.col("doc_id") == F.col("component_id")).alias("kept")
    judged = materialize(found.select("doc_id", "n_shingles", kept), "judged")
    gone = judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept").select("doc_id")
    gone = materialize(gone, "gone")
    known = docs.where("doc_id is not null")
    doubtful = sifted(known, gone, "doc_id").join(gone, "doc_id", "left_anti")
    out = sifted(known, gone, "doc_id", "left_anti").unionByName(doubtful)
    if judged.where("kept and n_shingles > 0").groupBy("doc_id").count().where("count > 1").limit(1).count():
        # Several rows of one id: rows of the same words are copies of each other.
        name = free_name(docs, "copy")
        same = F.when(F.trim("text") != "", F.lower(F.regexp_replace(F.trim("text"), r"[\x20\x09-\x0D]+", " ")))
        keyed = out.withColumn(name, F.coalesce(same, F.uuid()))
        out = keyed.dropDuplicates(["doc_id", name]).drop(name)
    return out.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def digest(docs: DataFrame) -> DataFrame:
    """Every document with the size of its set of three-word shingles and the least document it is linked with."""
    return Join(docs.select("doc_id", "text"), n=3, percent=90).labelled()
