"""Merkle manifest: one hash for a dataset, with a proof for every row.

Every row is a leaf. The leaves of a group, by ascending id, are hashed in runs
of ``fanout`` consecutive ones, level by level, until one node is left, the
group's subroot; the subroots, by group, give the root in the same way. A row's
proof are the other nodes of its run on every level; folding its leaf with them
must give the root.

A leaf's place in its group is found without sorting the leaves. The ids of a
group are a compressed bitmap: 64 ids are one word, 64 words one container that
holds its words with any id, a bitmap of which words these are, and a directory
of the rows before each. Words and containers are merged by hash aggregation
(combined below the shuffle); only containers are ordered, by range, to sum up
the rows before each. A row asks its container: rows before the container, plus
those before the word, plus the bits below its own.

Knowing its place, a node knows its slot: a block of ``fanout ** k`` consecutive
nodes (729 at most by default) is collected into an array of slots by its key and reduced
``k`` levels at once, so the shuffles are few (one for every six levels) and no
task holds more than a block per group. On the way back each block gets the path of its
own root, and gives its nodes theirs.

Each step is stored in the shared folder, so lost executors cost a re-read.

Cases: a null value is ``-`` in the leaf. Null groups and null ids come first. Rows
with the same id stand next to each other by their leaf; equal rows are
interchangeable, and each has a place of its own. A hot id or group is dealt
like any other: its repeated rows are numbered by range. An empty table has no
root and gives no rows. Only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, running, ship

FANOUT = 3
BLOCK = 729
_WORD = 6  # bits: 64 ids a word, 64 words a container


def leaf_hash(values: Sequence[Column]) -> Column:
    """sha256 in hex over the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def _hash(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def _low(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).bitwiseAND(63).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def _below(bits: Column, at: Column) -> Column:
    """How many of the bits stand below ``at``."""
    mask = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), at))
    return F.bit_count(bits.bitwiseAND(mask))


def _containers(leaves: DataFrame) -> DataFrame:
    """The compressed bitmaps of all groups, one row per container."""
    by_id = leaves.groupBy("grp", "id").agg(F.count(F.lit(1)).alias("n"))
    repeated = F.when(F.col("n") > 1, F.struct(_low(F.col("id")).alias("bit"), (F.col("n") - 1).alias("more")))
    words = by_id.groupBy("grp", F.shiftright("id", _WORD).alias("word")).agg(
        F.bit_or(_bit(_low(F.col("id")))).alias("bits"),
        F.sum("n").alias("rows"),
        F.collect_list(repeated).alias("repeats"),  # nulls are left out
    )
    slot = F.struct(_low(F.col("word")).alias("at"), "bits", "rows", "repeats")
    held = words.groupBy("grp", F.shiftright("word", _WORD).alias("container")).agg(
        F.bit_or(_bit(_low(F.col("word")))).alias("present"),
        F.sum("rows").alias("rows"),
        F.array_sort(F.collect_list(slot)).alias("slots"),
    )
    return held.select(
        "grp",
        "container",
        "present",
        "rows",
        F.transform("slots", lambda s: s["bits"]).alias("words"),
        F.transform(
            "slots",
            lambda s, i: F.aggregate(F.slice("slots", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, b: a + b["rows"]),
        ).alias("directory"),
        F.transform("slots", lambda s: s["repeats"]).alias("repeats"),
    )


def _placed(leaves: DataFrame, carried: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place in the group and the group's size, and the groups."""
    bitmap = running(_containers(leaves), ["grp", "container"], {"before": "rows"})
    groups = materialize(
        bitmap.groupBy("grp").agg(F.min("before").alias("base"), F.sum("rows").alias("n")), "merkle-groups"
    )
    own = groups.withColumnRenamed("grp", "of")
    bitmap = bitmap.join(own, F.col("grp").eqNullSafe(F.col("of"))).select(
        F.col("grp").alias("of"), F.col("container").alias("within"), "present", "words", "directory", "repeats",
        (F.col("before") - F.col("base")).alias("before"), "n",
    )
    word = F.shiftright("id", _WORD)
    index = F.col("index")
    repeats = F.element_at("repeats", index)
    found = (
        leaves.withColumn("container", F.shiftright("id", 2 * _WORD))
        .join(bitmap, F.col("grp").eqNullSafe(F.col("of")) & F.col("container").eqNullSafe(F.col("within")))
        .withColumn("index", 1 + _below(F.col("present"), _low(word)))
    )
    bit = _low(F.col("id"))

    def copies(wanted) -> Column:
        return F.aggregate(F.filter(repeats, wanted), F.lit(0).cast("bigint"), lambda a, r: a + r["more"])

    rows = found.select(
        "grp",
        "id",
        "leaf",
        *carried,
        "n",
        (
            F.col("before")
            + F.element_at("directory", index)
            + _below(F.element_at("words", index), bit)
            + copies(lambda r: r["bit"] < bit)
        ).alias("pos"),
        copies(lambda r: r["bit"] == bit).alias("more"),
    )
    rows = materialize(rows, "merkle-placed")
    again = rows.where("more > 0")
    if not again.isEmpty():
        # Copies of an id share its first place: number them, by range, with a number that parts equal rows.
        numbered = running(
            again.withColumn("copy", F.monotonically_increasing_id()), ["grp", "id", "leaf", "copy"], {}, rank="place"
        )
        first = numbered.groupBy("grp", "id").agg(F.min("place").alias("first")).select(
            F.col("grp").alias("of"), F.col("id").alias("within"), "first"
        )
        numbered = numbered.join(first, F.col("grp").eqNullSafe(F.col("of")) & F.col("id").eqNullSafe(F.col("within")))
        numbered = numbered.withColumn("pos", F.col("pos") + F.col("place") - F.col("first"))
        rows = rows.where("more = 0").unionByName(numbered.select(*rows.columns))
    return rows.drop("more"), groups


def _levels(n: int, fanout: int, most: int) -> int:
    """Levels until one of ``n`` nodes is left, ``most`` at most."""
    t = 0
    while n > 1 and t < most:
        n, t = -(-n // fanout), t + 1
    return t


def _reduce(nodes: list[str], fanout: int, levels: int) -> list[list[str]]:
    """All levels of a block, the nodes first."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_hash("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return out


def fold_path(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf leads to by its path: per level the nodes left of it, ``|``, those right of it."""
    for step in path:
        left, right = step.split("|")
        leaf = _hash(left + leaf + right)
    return leaf


@dataclass
class _Tree:
    """Nodes by (grp, pos) with their group's size, reduced block by block."""

    fanout: int
    block: int

    def __post_init__(self):
        self.depth = max(1, _levels(self.block, self.fanout, 64))
        while self.depth > 1 and self.fanout**self.depth > self.block:
            self.depth -= 1
        self.width = self.fanout**self.depth

    def blocks(self, nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        slot = F.struct("pos", "h", *carried)
        key = F.floor(F.col("pos") / self.width).alias("block")
        return nodes.groupBy("grp", key, "n").agg(F.array_sort(F.collect_list(slot)).alias("slots"))

    def up(self, nodes: DataFrame, largest: int) -> list[DataFrame]:
        """The nodes of every round; the last has one per group."""
        rounds, fanout, depth = [nodes], self.fanout, self.depth

        def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, slots = batch.column("n").to_pylist(), batch.column("slots").to_pylist()
                roots, left = [], []
                for n, nodes_of in zip(sizes, slots, strict=True):
                    t = _levels(n, fanout, depth)
                    roots.append(_reduce([s["h"] for s in nodes_of], fanout, t)[-1][0])
                    left.append(-(-n // fanout**t))
                columns = [batch.column("grp"), batch.column("block"), pa.array(roots, pa.string()), pa.array(left, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "pos", "h", "n"])

        while largest > 1:
            kind = rounds[-1].schema["grp"].dataType.simpleString()
            upper = self.blocks(rounds[-1]).mapInArrow(reduce, f"grp {kind}, pos bigint, h string, n bigint")
            rounds.append(materialize(upper, "merkle-nodes"))
            largest = -(-largest // self.width)
        return rounds

    def down(self, nodes: DataFrame, paths: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        """The nodes with their own path: inside their block, then that of the block's root."""
        fanout, depth = self.fanout, self.depth
        over = paths.select(F.col("grp").alias("of"), F.col("pos").alias("within"), "path", "subroot")
        blocks = self.blocks(nodes, carried).join(
            over, F.col("grp").eqNullSafe(F.col("of")) & (F.col("block") == F.col("within"))
        )
        blocks = blocks.select("grp", "n", "slots", "path", "subroot")
        kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
        schema = f"grp {kinds['grp']}, pos bigint, h string, n bigint, path array<string>, subroot string"
        schema += "".join(f", {c} {kinds[c]}" for c in carried)

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):  # one block at a time: its paths are the largest thing held
                    one = batch.slice(i, 1)
                    n, upper, top = (one.column(c)[0].as_py() for c in ("n", "path", "subroot"))
                    held = one.column("slots").values.slice(
                        one.column("slots").offsets[0].as_py(), len(one.column("slots")[0])
                    )
                    hashes = held.field("h").to_pylist()
                    levels = _reduce(hashes, fanout, _levels(n, fanout, depth))[:-1]
                    paths_of = []
                    for at in range(len(hashes)):
                        own = []
                        for level in levels:
                            start = at - at % fanout
                            left, right = level[start:at], level[at + 1 : start + fanout]
                            own.append("".join(left) + "|" + "".join(right))
                            at //= fanout
                        paths_of.append(own + upper)
                    size = len(hashes)
                    columns = {
                        "grp": one.column("grp").take(pa.array([0] * size)),
                        "pos": held.field("pos"),
                        "h": held.field("h"),
                        "n": pa.array([n] * size, pa.int64()),
                        "path": pa.array(paths_of, pa.list_(pa.string())),
                        "subroot": pa.array([top] * size, pa.string()),
                    } | {c: held.field(c) for c in carried}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return blocks.mapInArrow(expand, schema)


@dataclass
class Manifest:
    """The root (None for no rows), the subroots by group, and the leaves with their paths.

    ``leaves`` has ``id``, ``grp``, ``pos``, ``leaf``, ``subroot``, ``path`` and the
    carried columns; it is a plan that is expanded block by block when it is read.
    """

    root: str | None
    subroots: DataFrame
    leaves: DataFrame


def build(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    carried: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    block: int = BLOCK,
) -> Manifest:
    """The manifest of ``docs``: ``columns`` are hashed, ``carried`` are further values kept beside each leaf."""
    if fanout < 2 or block < fanout:
        raise ValueError("a node has at least two children, and a block holds at least one node's")
    spark = docs.sparkSession
    ship(spark)
    extra = dict(carried or {})
    leaves = materialize(
        docs.select(
            F.col(f"`{group_col}`").alias("grp"),
            F.col(f"`{id_col}`").cast("bigint").alias("id"),
            leaf_hash([F.col(f"`{c}`") for c in columns]).alias("leaf"),
            *[value.alias(name) for name, value in extra.items()],
        ),
        "merkle-leaves",
    )
    placed, groups = _placed(leaves, list(extra))
    tree = _Tree(fanout, block)
    nodes = placed.withColumnRenamed("leaf", "h")
    rounds = tree.up(nodes, groups.agg(F.max("n")).first()[0] or 0)

    # The same over the subroots, as one group.
    ranked = running(rounds[-1].select("grp", "h"), ["grp"], {}, rank="pos")
    number = groups.count()
    over = ranked.select(
        F.lit(0).alias("grp"), F.col("grp").alias("group"), "pos", "h", F.lit(number).cast("bigint").alias("n")
    )
    upper = tree.up(over, number)
    top = upper[-1].select("h").first()
    paths = upper[-1].select("grp", "pos", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"))
    for nodes_of in reversed(upper[1:-1]):
        paths = materialize(tree.down(nodes_of, paths), "merkle-paths")
    subroots = tree.down(over, paths, ["group"]) if len(upper) > 1 else over.withColumn(
        "path", F.array().cast("array<string>")
    )
    subroots = materialize(
        subroots.select(F.col("group").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("h").alias("subroot")),
        "merkle-paths",
    )
    paths = subroots
    for nodes_of in reversed(rounds[1:-1]):
        paths = materialize(tree.down(nodes_of, paths), "merkle-paths")
    kept = ["id", *extra]
    if len(rounds) > 1:
        full = tree.down(nodes, paths, kept)
    else:  # every group is a lone leaf
        alone = paths.select(F.col("grp").alias("of"), "path", "subroot")
        full = nodes.join(alone, F.col("grp").eqNullSafe(F.col("of"))).drop("of")
    out = full.select("id", "grp", "pos", F.col("h").alias("leaf"), "subroot", "path", *extra)
    return Manifest(top[0] if top else None, subroots.select("grp", "subroot"), out)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by its path, level by level."""

    def step(h: Column, nodes: Column) -> Column:
        sides = F.split(nodes, r"\|")
        return F.sha2(F.concat(sides[0], h, sides[1]).cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def proof_hash(path: Column) -> Column:
    """sha256 over the siblings, level by level, left to right."""
    return F.sha2(F.replace(F.array_join(path, ""), F.lit("|"), F.lit("")).cast("binary"), 256)


def tampered(docs: DataFrame) -> dict[str, Column]:
    """The leaves of :func:`digest` after half of the documents lost their line feeds."""
    text = F.when(fold(F.col("doc_id"), 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return {"offered": leaf_hash([*values, text])}


def digest(docs: DataFrame) -> DataFrame:
    """Per document: its leaf, the roots, its proof's hash, and whether the text as found later leads to the root."""
    manifest = build(docs, carried=tampered(docs))
    root = F.lit(manifest.root).cast("string")
    return manifest.leaves.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        proof_hash(F.col("path")).alias("proof_sha256"),
        folded(F.col("offered"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same level by level; ids are taken to be unique and not null.
ORACLE = r"""
with recursive doc as (
  select row_number() over () as r, *,
    list_reduce(list_concat([4294967295::ubigint], [ascii(d)::ubigint for d in string_split(doc_id::varchar, '')]),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::ubigint for k in range(8)]),
        lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384::ubigint) else x // 2 end)) as crc
  from documents
), part as (
  select *, case when crc % 2 = 1 then replace(text, chr(10), '') else text end as offered_text,
    strlen(doc_id::varchar) || ':' || doc_id || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
  from doc
), leaf as (
  select r, doc_id, coalesce('=' || source, '-') as s,
    row_number() over (partition by source order by doc_id) - 1 as pos,
    count(*) over (partition by source) as n,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) as h,
    sha256(head || coalesce(strlen(offered_text) || ':' || offered_text, '-')) as offered
  from part
), node(s, lvl, pos, n, h) as (
  select s, 0, pos, n, h from leaf
  union all
  select s, lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' order by pos))
  from node where n > 1 group by s, lvl, pos // 3
), sub as (
  select s, h, row_number() over (order by s) - 1 as pos, count(*) over () as n from node where n = 1
), upper(lvl, pos, n, h) as (
  select 0, pos, n, h from sub
  union all
  select lvl + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' order by pos))
  from upper where n > 1 group by lvl, pos // 3
), path(r, s, lvl, pos, n, h, proof) as (
  select r, s, 0, pos, n, offered, '' from leaf
  union all
  select p.r, p.s, p.lvl + 1, p.pos // 3, (any_value(p.n) + 2) // 3,
    sha256(string_agg(case when q.pos = p.pos then p.h else q.h end, '' order by q.pos)),
    p.proof || coalesce(string_agg(q.h, '' order by q.pos) filter (q.pos <> p.pos), '')
  from path p join node q on q.s = p.s and q.lvl = p.lvl and q.pos // 3 = p.pos // 3
  where p.n > 1 group by p.r, p.s, p.lvl, p.pos, p.proof
), high(r, lvl, pos, n, h, proof) as (
  select r, 0, sub.pos, sub.n, path.h, proof from path join sub using (s) where path.n = 1
  union all
  select p.r, p.lvl + 1, p.pos // 3, (any_value(p.n) + 2) // 3,
    sha256(string_agg(case when q.pos = p.pos then p.h else q.h end, '' order by q.pos)),
    p.proof || coalesce(string_agg(q.h, '' order by q.pos) filter (q.pos <> p.pos), '')
  from high p join upper q on q.lvl = p.lvl and q.pos // 3 = p.pos // 3
  where p.n > 1 group by p.r, p.lvl, p.pos, p.proof
)
select doc_id, leaf.h as leaf, sub.h as subroot, upper.h as root, sha256(high.proof) as proof_sha256,
  high.h as folded_root, high.h = upper.h as verified
from leaf join sub using (s) join high using (r), upper where high.n = 1 and upper.n = 1
"""
