"""Token ids in bit-plane files.

Documents are tokenized in ascending id order, an end id after each, and written
to files of about ``FILE_IDS`` ids. In a file, the ids stand in blocks of fixed
size; a block is transposed into planes, one per bit or byte of an id, and each
plane is compressed by itself with zstandard. A chunk index says where the
blocks lie, how long their planes are and their checksums, so that a block is
read without the others; a document index says where documents begin.

Layout of a file, little-endian: ``magic(4) kind(u1) width(u1) zero(u2)
block_ids(u4) n_blocks(u4) n_docs(u4) n_ids(u8)``; then for every block
``offset(u8) n(u4) crc32(u4) planes(u4 * P)``; then the documents ``known(u1 * D)
doc_id(i8 * D) n_tokens(u4 * D)``; then the planes. ``width`` is the bytes of an
id (2 or 4), P is ``width`` for byte planes and ``8 * width`` for bit planes.

A file is one row of the table ``store`` writes: its place in the order, what
it holds, and its bytes. Spark commits the table, so a lost executor leaves no
half file, and it works on any store that Spark can write. One shuffle puts
documents in order; a range holds whole files, and only the id totals of the
ranges (one row each) pass the driver.

Cases: a null or empty text has the end id alone; a null id comes first. Rows of
the same id stand next to each other, ordered by text. A document longer than a
file has one of its own. An empty table has no files and no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, give_back, giving_back, materialize, slices

MAGIC = b"BPT1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 20
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers the ids of; half of them are those used last, and the other half is forgotten for more.
_WORDS = 700_000
_HEAD = struct.Struct("<4sBBHIIIQ")


def _planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    columns = ids.astype(f"<u{width}").view(np.uint8).reshape(len(ids), width)
    if bits:
        columns = np.unpackbits(columns, axis=1)
        return [np.packbits(c).tobytes() for c in np.ascontiguousarray(columns.T)]
    return [c.tobytes() for c in np.ascontiguousarray(columns.T)]


def _ids(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    rows = np.array([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n).T, axis=1)
    else:
        rows = rows.T
    return np.ascontiguousarray(rows).view(f"<u{width}").reshape(n).astype("<u4")


def pack(doc_ids: list[int | None], documents: list[np.ndarray], block_ids: int = BLOCK_IDS, bits: bool = False) -> bytes:
    """The bytes of a file that holds the ids of ``documents``."""
    ids = np.concatenate([np.asarray(d, dtype="<u4") for d in documents]) if documents else np.empty(0, "<u4")
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    zstd, index, body, offset = zstandard.ZstdCompressor(level=3), [], [], 0
    for start in range(0, len(ids), block_ids):
        block = ids[start : start + block_ids]
        planes = [zstd.compress(p) for p in _planes(block, width, bits)]
        index.append(struct.pack(f"<QII{len(planes)}I", offset, len(block), zlib.crc32(block), *map(len, planes)))
        body += planes
        offset += sum(map(len, planes))
    known = np.array([d is not None for d in doc_ids], dtype="u1")
    names = np.array([d or 0 for d in doc_ids], dtype="<i8")
    lengths = np.array([len(d) for d in documents], dtype="<u4")
    head = _HEAD.pack(MAGIC, int(bits), width, 0, block_ids, len(index), len(doc_ids), len(ids))
    return b"".join([head, *index, known.tobytes(), names.tobytes(), lengths.tobytes(), *body])


class TokenFile:
    """Reads the bytes of a file."""

    def __init__(self, data: bytes):
        magic, bits, self.width, _, self.block_ids, blocks, docs, self.n_ids = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bits, n_planes = bool(bits), self.width * (8 if bits else 1)
        entry = struct.Struct(f"<QII{n_planes}I")
        at = _HEAD.size
        self.index = [entry.unpack_from(data, at + i * entry.size) for i in range(blocks)]
        at += blocks * entry.size
        known = np.frombuffer(data, "u1", docs, at)
        names = np.frombuffer(data, "<i8", docs, at + docs)
        self.lengths = np.frombuffer(data, "<u4", docs, at + 9 * docs)
        self.doc_ids = [int(n) if k else None for k, n in zip(known, names, strict=True)]
        self.data, self.body = data, at + 13 * docs

    def block(self, i: int) -> np.ndarray:
        offset, n, crc, *sizes = self.index[i]
        zstd, planes, at = zstandard.ZstdDecompressor(), [], self.body + offset
        for size in sizes:
            planes.append(zstd.decompress(self.data[at : at + size]))
            at += size
        ids = _ids(planes, n, self.width, self.bits)
        if zlib.crc32(ids) != crc:
            raise ValueError(f"block {i} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, place of the first token in the file, and token ids of each document."""
        held, first, start, blocks = np.empty(0, "<u4"), 0, 0, iter(range(len(self.index)))
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist(), strict=True):
            parts = [held[start - first :]]
            while sum(map(len, parts)) < n:
                parts.append(self.block(next(blocks)))
            held, first = np.concatenate(parts), start
            yield doc_id, start, held[:n]
            start += n


#: Marks at the end of a word of letters. The tokenizer parts them from letters and keeps
#: them together, so that a space between changes nothing.
_MARKS = ".,!%$&*#|"
#: Words of these are one word to the tokenizer, and one letter in lower case for each; the only other
#: letter of the range, U+0130, has two.
_LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")


def _byte_letters() -> dict[int, int]:
    """The characters that stand for bytes, where they are others, in the vocabulary of a byte-level tokenizer."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 0x100 + i for i, b in enumerate(sorted({*range(0x100)} - {*own}))}


class _Encoder:
    """Ids of texts through a tokenizer that never joins words across ASCII space.

    A different word passes the tokenizer once per worker, without the case of ASCII
    letters, as the tokenizer lower-cases all but special tokens, and without marks at
    its end, which are words of their own. Plain letters are one word to the tokenizer
    and go to its model directly; all else passes the whole tokenizer in one string,
    told apart by token offsets. Words are found and counted off by Arrow, so that
    Python handles each different word of a batch once, and not each word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        #: What was used last, and before that.
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        tokenize, odd = self.tokenizer.model.tokenize, []
        for w in words:
            if w.isalpha():  # of bytes: ASCII letters
                plain = w.decode()
            elif _LATIN.fullmatch(text := w.decode("utf-8", "replace")):
                plain = text.lower().encode().decode("latin-1").translate(self.letters)
            else:
                odd.append(w)
                continue
            ids = [t.id for t in tokenize(plain)]
            self.words[w] = struct.pack(f"<{len(ids)}I", *ids)
        for start in range(0, len(odd), 5000):
            part = odd[start : start + 5000]
            texts = [w.decode("utf-8", "replace") for w in part]
            begins = np.cumsum([0] + [len(t) + 1 for t in texts])
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            at = np.array([o[0] for o in found.offsets], dtype=np.int64)
            cut = (4 * np.searchsorted(at, begins)).tolist()
            for w, a, b in zip(part, cut[:-1], cut[1:], strict=True):
                self.words[w] = ids[a:b]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, of which new ones are learned."""
        held = list(map(self.words.get, words))
        missing = [i for i, ids in enumerate(held) if ids is None]
        new = {words[i] for i in missing}
        kept = {w: self.older[w] for w in new & self.older.keys()}
        if len(self.words) + len(new) > _WORDS // 2:
            self.older, self.words = self.words, {}
        self.words.update(kept)
        self._learn(list(new - kept.keys()))
        for i in missing:
            held[i] = self.words[words[i]]
        return held

    def _ids_of(self, words: pa.Array) -> list[bytes]:
        """The ids of different words, marks at their ends apart."""
        stems = pc.ascii_rtrim(words, characters=_MARKS)
        sizes, kept = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (words, stems))
        marked = np.flatnonzero((sizes > kept) & (kept > 0) & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False))
        if len(marked):
            last = np.frombuffer(stems.buffers()[2], np.uint8)[np.cumsum(kept)[marked] - 1]
            marked = marked[(last >= ord("a")) & (last <= ord("z"))]
        parts, marks = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), []
        for i, n in zip(marked.tolist(), kept[marked].tolist(), strict=True):
            marks.append(parts[i][n:])
            parts[i] = parts[i][:n]
        held = self._known(parts)
        for i, ids in zip(marked.tolist(), self._known(marks), strict=True):
            held[i] += ids
        return held

    def ids(self, texts: list[str | None] | pa.Array, end_id: int | None = None) -> list[np.ndarray]:
        """The ids of each text, and ``end_id`` after them."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(column):
            return []
        column = pc.fill_null(column.cast(pa.string()), "")
        lowered, special = pc.ascii_lower(column), pc.match_substring(column, "<|")
        if pc.any(special).as_py():  # may spell a special token, which knows case
            rows = [t.encode().split() for t in column.filter(special).to_pylist()]
            rows = [b" ".join(w if b"<|" in w else w.lower() for w in row).decode() for row in rows]
            lowered = pc.replace_with_mask(lowered, special, pa.array(rows, pa.string()))
        lines = pc.ascii_split_whitespace(lowered)
        words = lines.values.dictionary_encode()
        held = self._ids_of(words.dictionary)
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        table = np.frombuffer(b"".join([*held, bytes(4)]), "<u4")
        begins, codes = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = table[np.repeat(begins[codes] - ends[:-1], n) + np.arange(ends[-1])]
        cut = ends[lines.offsets.to_numpy()[1:]]
        if end_id is not None:
            ids, cut = np.insert(ids, cut, end_id), cut + np.arange(1, 1 + len(cut))
        return np.split(ids, cut[:-1])


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One encoder per worker process, kept between its tasks."""
    return _Encoder(path)


_FILE = "part int, seq int, start bigint, n_docs int, n_ids bigint, data binary"
_ARROW = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
     ("data", pa.binary())]
)


def _writer(path: str, end_id: int, file_ids: int, block_ids: int, bits: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        seq = start = size = 0
        names: list[int | None] = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            row = [part, seq, start, len(names), size, pack(names, held, block_ids, bits)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in slices(batches, "text", 2 << 20):
            ids = batch.column(0).to_pylist()
            for doc_id, doc in zip(ids, encoder.ids(batch.column(1), end_id), strict=True):
                if names and size + len(doc) > file_ids:
                    yield flush()
                    give_back()
                    seq, start, size, names, held = seq + 1, start + size, 0, [], []
                names.append(doc_id)
                held.append(doc)
                size += len(doc)
        if names:
            yield flush()

    return write


def store(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    block_ids: int = BLOCK_IDS,
    bits: bool = False,
) -> DataFrame:
    """Tokenize, write files in ascending id order to the shared folder, and give the table of files."""
    lines = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ordered = lines.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    return materialize(ordered.mapInArrow(giving_back(_writer(tokenizer, end_id, file_ids, block_ids, bits)), _FILE), "token-files")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _encoder.cache_clear()  # all is written by now
    for batch in batches:
        bases, data = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            rows = [
                (doc_id, bases[i].as_py() + start, len(ids), zlib.crc32(ids.tobytes()))
                for doc_id, start, ids in TokenFile(data[i].as_py()).documents()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def read_index(files: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``, decoded from their bytes."""
    # One row per range of the sort, which is per shuffle partition.
    totals = files.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect()
    bases, before = [], 0
    for part, n in totals:
        bases.append((part, before))
        before += n
    base = few(files.sparkSession, bases, "part int, base bigint")
    return (
        files.join(F.broadcast(base), "part")
        .select((F.col("base") + F.col("start")).alias("base"), "data")
        .mapInArrow(giving_back(_reader), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def public_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def digest(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` and give what is read back from them."""
    return read_index(store(docs, public_path()))
