"""The Merkle manifest against trees built in one list."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from hustings.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def reduced(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        start = at - at % fanout
        out.append((level[start:at], level[at + 1 : start + fanout]))
        at //= fanout
    return out


def expected(rows, fanout=3):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of((doc_id, source, lang, n_chars, text))
        even = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0
        later = text.replace("\n", "") if even and text is not None else text
        groups[source].append((doc_id, leaf, leaf_of((doc_id, source, lang, n_chars, later))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = reduced([r[1] for r in groups[source]], fanout)
    top = reduced([trees[s][-1][0] for s in order], fanout)
    for g, source in enumerate(order):
        for at, (doc_id, leaf, offered) in enumerate(groups[source]):
            steps = siblings(trees[source], at, fanout) + siblings(top, g, fanout)
            root = offered
            for left, right in steps:
                root = sha("".join(left) + root + "".join(right))
            proof = sha("".join("".join(left + right) for left, right in steps))
            yield doc_id, leaf, trees[source][-1][0], top[-1][0], proof, root, root == top[-1][0]


def rows_of(df):
    return Counter(map(repr, map(tuple, df.collect())))


def test_digest_on_odd_rows(odd, odd_rows, nothing):
    got = rows_of(M.digest(odd))
    assert got == Counter(map(repr, expected(odd_rows)))
    assert M.digest(nothing).collect() == []


@pytest.mark.parametrize("fanout,block", [(3, 729), (3, 9), (2, 4), (4, 17)])
def test_many_rounds(spark, fanout, block):
    rng = random.Random(block)
    rows = [(rng.choice([None, -5, 77, rng.randrange(-(2**62), 2**62), rng.randrange(9000)]), f"t\n{i % 40}", "en",
             rng.choice(["a", "a", "b", None, f"s{i % 50}"]), i % 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = M.build(docs.repartition(5), fanout=fanout, block=block)
    want = list(expected(rows, fanout))
    assert made.root == want[0][3]
    leaves = made.leaves.select("id", "leaf", "subroot", M.proof_hash(M.F.col("path")), M.folded(M.F.col("leaf"), M.F.col("path")))
    assert rows_of(leaves) == Counter(repr((*w[:3], w[4], made.root)) for w in want)
    one = made.leaves.first()
    assert M.fold_path(one.leaf, one.path) == made.root != M.fold_path(sha("other"), one.path)


def test_one_hot_id(spark):
    rows = [(7, f"t{i % 2}", None, "a", 1) for i in range(500)] + [(9, "x", None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = M.build(docs, block=27)
    assert sorted(r.pos for r in made.leaves.collect()) == list(range(501))
    assert rows_of(M.digest(docs)) == Counter(map(repr, expected(rows)))


def test_single_rows(spark):
    rows = [(i, "x", "en", s, 1) for i, s in enumerate("abc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(M.digest(docs)) == Counter(map(repr, expected(rows)))
    alone = M.digest(docs.limit(1)).first()
    assert alone.leaf == alone.root == alone.folded_root and alone.proof_sha256 == sha("")
    with pytest.raises(ValueError):
        M.build(docs, fanout=1)
