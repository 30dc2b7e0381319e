"""Near duplicates, contamination and search against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from hustings.llm import decontaminate, set_join, vector_search


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def groups(rows, n, percent):
    """(id, set size, least linked id) of rows with ids, by comparing all pairs."""
    items = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(items):
        for j in range(i):
            b = items[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(items):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(items))


@pytest.mark.parametrize("n, percent, chunk, bucket", [(3, 90, 2 << 20, 1 << 21), (5, 80, 2 << 20, 1 << 21), (3, 90, 1000, 500)])
def test_set_join(odd, odd_rows, monkeypatch, n, percent, chunk, bucket):
    monkeypatch.setattr(set_join, "CHUNK_BYTES", chunk)  # the last: many chunks ask many buckets
    monkeypatch.setattr(set_join, "BUCKET", bucket)
    got = set_join.Join(odd, n, percent).labelled().collect()
    want = groups([(r[0], r[1]) for r in odd_rows if r[0] is not None], n, percent)
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == want
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]


def edited(rng, words, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def test_set_join_of_a_large_group(spark, monkeypatch):
    """Edits of edits: chains of links, blocks that meet pairwise, and pairs near the threshold."""
    monkeypatch.setattr(set_join, "BLOCK", 32)
    monkeypatch.setattr(set_join, "TRIE", 8)
    rng = random.Random(3)
    base = [f"b{rng.randrange(5000)}" for _ in range(150)]
    texts = [" ".join(base)]
    while len(texts) < 160:
        texts.append(edited(rng, rng.choice(texts).split(), rng.choice([0.005, 0.01, 0.02, 0.05])))
    for k in range(20):  # small clusters beside the large one
        other = [f"o{k}-{rng.randrange(900)}" for _ in range(60)]
        texts += [edited(rng, other, 0.01) for _ in range(4)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in set_join.Join(docs, 3, 90).labelled().collect())
    assert got == groups(rows, 3, 90)
    assert len({g for _, _, g in got}) > 1


def test_ranks_are_true_numbers_of_documents(spark, monkeypatch):
    """Ranks from packed messages are those of plain counts, whatever the chunks and buckets."""
    monkeypatch.setattr(set_join, "CHUNK_BYTES", 400)
    monkeypatch.setattr(set_join, "BUCKET", 40)
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(2, 40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    shingles, counts = set_join.Shingler(2), Counter()
    for t in texts:
        counts.update(shingles(t).tolist())

    class Ranked(set_join.Join):
        def _join(self):
            return self.classes

    join = Ranked(docs, 2, 80)
    rows = join._ranked().collect()
    unzip = set_join.zstandard.ZstdDecompressor()
    assert len(rows) > 5 and max(len(r.answers) for r in rows) > 5
    for r in rows:
        sets = set_join._sets_of(r.asDict(), shingles, unzip)
        keys, _ = set_join._elements(sets)
        ranks = b"".join(unzip.decompress(bytes(a.ranks)) for a in sorted(r.answers, key=lambda a: a.bucket))
        for x in {g for s in sets for g in s.tolist()}:
            got = ranks[int(np.searchsorted(keys, np.uint64(x >> 10)))]
            assert got == (0 if counts[x] < 2 else min(15, counts[x].bit_length()))


def test_shared_keys_lose_no_link(spark, monkeypatch):
    """With so few keys that most n-grams share one, only the order differs: the groups are those of brute force."""
    monkeypatch.setattr(set_join, "key_bits", lambda grams: 6)
    rng = random.Random(15)
    rows = []
    for i in range(0, 60, 3):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 90))]
        rows.append((i, " ".join(base)))
        for k in (1, 2):
            edited = list(base)
            for _ in range(k):
                edited[rng.randrange(len(edited))] = "edited"
            rows.append((i + k, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in set_join.Join(docs, 3, 80).labelled().collect())
    assert got == sorted((d, n, g) for d, n, g in groups(rows, 3, 80))
    assert 20 <= len({g for _, _, g in got}) < 60


def test_sifted_loses_no_wanted_row(spark, monkeypatch):
    rows = spark.range(-1000, 50000).selectExpr("id as doc_id", "'x' as text")
    wanted = spark.range(-1000, 50000, 41).selectExpr("id as doc_id")
    for most, least_dropped in ((1 << 26, 0.9), (1 << 15, 0.9), (8, 0.0)):
        monkeypatch.setattr(set_join, "SIEVE_BITS", most)
        out = set_join.sifted(rows, wanted.unionByName(wanted), "doc_id")
        assert out.columns == rows.columns
        got = [r.doc_id for r in out.collect()]
        assert len(got) == len(set(got)) and set(range(-1000, 50000, 41)) <= set(got)
        assert len(got) <= 1244 + (1 - least_dropped) * 51000
    assert set_join.sifted(rows, wanted.limit(0), "doc_id").count() == 0


def test_classes_of_many_rows_meet_no_shuffle(spark, monkeypatch):
    """Rows of a class with more than its share of all rows, and rows without words, get the same groups."""
    rows = [(i, "one text of a good many copies here") for i in range(100)] + [(100 + i, f"text {i} a{i} b{i}") for i in range(40)]
    rows += [(200 + i, None if i % 2 else " ") for i in range(50)] + [(None, "one text of a good many copies here"), (7, "another text of that id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def by_id(found):
        return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found.collect()))

    results = []
    for share in (4, 10**9, 1):  # the copies are broadcast; every class; none
        monkeypatch.setattr(set_join, "HOT", share)
        results.append(by_id(set_join.Join(docs, 3, 90).labelled()))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(rows)
    assert all(r[3] == 0 for r in results[0] if r[1] < 100 and not r[0] and r[2] == 6)


def test_set_join_of_nothing(nothing):
    assert set_join.digest(nothing).collect() == []
    assert set_join.deduplicated(nothing).collect() == []


def test_sifted_gives_the_rest(spark):
    rows = spark.range(3000).selectExpr("cast(id as int) doc_id", "id % 7 other")
    gone = spark.range(0, 3000, 5).toDF("doc_id")
    rest = {r.doc_id for r in set_join.sifted(rows, gone, "doc_id", "left_anti").collect()}
    held = {r.doc_id for r in set_join.sifted(rows, gone, "doc_id").collect()}
    assert rest | held == set(range(3000)) and not rest & held
    assert set(range(0, 3000, 5)) <= held and len(held) < 1000


def test_deduplicated_shuffles_only_doubtful_texts(spark, odd):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = set_join.deduplicated(odd.where("doc_id >= 20"), 5, 80)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_deduplicated_keeps_one_of_each_group(odd, odd_rows):
    out = set_join.deduplicated(odd, 5, 80)
    assert out.columns == odd.columns
    got = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    least = groups([(r[0], r[1]) for r in odd_rows if r[0] is not None], 5, 80)
    assert got == sorted({g for _, _, g in least})
    assert out.where("doc_id is null").count() == 2


def test_trie_links_what_comparing_links():
    rng = np.random.default_rng(1)
    base = np.sort(rng.choice(10**6, 60, replace=False)).astype(np.uint64)
    sets = []
    for i in range(80):
        s = np.where(rng.random(60) < rng.choice([0, 0.02, 0.1]), rng.choice(10**6, 60), base).astype(np.uint64)
        sets.append((i, np.unique(s[: rng.integers(50, 61)])))
    for percent in (80, 90, 100):
        want = [i for i, s in sets if 100 * len(np.intersect1d(s, base)) >= percent * len(np.union1d(s, base))]
        assert sorted(set_join.Trie(sets).linked(base, percent)) == want


def contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {}
    for item, text in items:
        w = low(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = low(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_decontamination(spark, odd, odd_rows):
    first = odd_rows[0][1].split()
    items = [(1, " ".join(first[5:30])), (2, " ".join(first[20:50])), (10, "one TWO"), (3, None), (4, ""), (None, "two"), (10, "Two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination([(r[0], r[1]) for r in odd_rows], items)
    got = sorted((str(r[0]), *r[1:]) for r in decontaminate.digest(odd, bench).collect())
    assert got == want
    found, names = decontaminate.find(odd, bench, part_bytes=64)  # dealt into parts, one scan each
    assert sorted((str(r.doc_id), r[names["n_hit"]], len(r[names["item_ids"]])) for r in found.collect()) == [(w[0], w[2], w[3]) for w in want]
    kept = decontaminate.remove_documents(odd, bench)
    assert kept.columns == odd.columns and kept.count() == sum(not w[5] for w in want)
    assert decontaminate.digest(odd, bench.where("false")).where("n_hit > 0").count() == 0


def test_decontamination_of_nothing(spark, nothing):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.digest(nothing, bench).collect() == []


def nearest(rows, every, k):
    rows = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in rows if i % every == 0}):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"segment": 40, "block": 8}, {"segment": 40, "block": 8, "bound_bytes": 2000, "groups": 1}])
def test_top_k(spark, options):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(i % 3, 1, 6).round(1).tolist()) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, None, 2.0]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (305, [2.0, 1.0]),
             (None, [9.0] * 6), (306, [1e18] * 6), (4, rows[5][1]), (10, rows[10][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    got = sorted(tuple(r) for r in vector_search.top_k(frame, 10, **options).collect())
    assert got == nearest([r for r in rows if r[0] != 306], 10, 5)


@pytest.mark.parametrize("groups", [1, 512])
def test_top_k_of_copies_across_segments(spark, groups):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).round(1).tolist()) for i in range(1, 60)]
    rows += [(100, [1.0, 2.0, -1.0, 0.5])] * 100  # more than two segments of one query
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_search.top_k(frame, 100, segment=40, block=8, groups=groups).collect()
    assert sorted(tuple(r) for r in got) == nearest(rows, 100, 5)


@pytest.mark.parametrize("groups", [1, 512])
def test_top_k_of_an_id_with_different_vectors(spark, groups):
    rng = np.random.default_rng(4)
    rows = [(i // 2, rng.normal(0, 1, 4).round(1).tolist()) for i in range(2, 160)]  # two rows of an id are two candidates
    mine = [rng.normal(0, 1, 4).round(1).tolist() for _ in range(70)]
    mine += [mine[0], [1.0], [1.0, 0.0]]
    frame = spark.createDataFrame(rows + [(100, v) for v in mine], "vec_id long, embedding array<double>")
    got = vector_search.top_k(frame, 100, segment=40, block=8, groups=groups).collect()
    scaled = lambda v: [int(np.floor(256 * x)) for x in v]
    best = [(-max(sum(a * b for a, b in zip(scaled(v), scaled(w))) for v in mine), i) for i, w in rows]
    assert sorted(tuple(r) for r in got) == [(100, r + 1, i, -s) for r, (s, i) in enumerate(sorted(best)[:5])]


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in vector_search.digest(frame).collect()) == nearest(rows, 50, 5)
    assert vector_search.digest(frame.where("false")).collect() == []


def test_word_hashes_part_words_as_split_does():
    rng = random.Random(8)
    hashes, seen = set_join.Shingler(3), {}
    for _ in range(400):
        text = "".join(rng.choice("abA éß.\n\t\x0b\x1c\x85\u2003") for _ in range(rng.randrange(40)))
        words = text.encode().lower().split()
        got = hashes.words(text).tolist()
        assert len(got) == len(words)
        for w, h in zip(words, got):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    long = ("word " * 300_000) + "x" * 1_500_000 + " end"  # pieces, and a word longer than a piece
    got = hashes.words(long)
    assert len(got) == 300_002 and len(set(got.tolist())) == 3 and got[-1] == hashes.words("END")[0]
