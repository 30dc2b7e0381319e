"""Periodic runs against a walk over every period."""

import hashlib
import random
import zlib

import pytest

from hustings.llm import periodic_runs as R


def walked(words, exponent=R.EXPONENT, least=R.LEAST):
    """Every period is tried at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, exponent * q) and i > start:
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def left_over(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def drawn(rng, letters, n):
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if n > 3 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 5), (2, 7)])
def test_runs_of_drawn_words(exponent, least):
    rng = random.Random(exponent)
    for _ in range(400):
        docs = [drawn(rng, rng.choice([1, 2, 3, 5]), rng.randrange(60)) for _ in range(4)]
        got = R.runs_of(docs, exponent, least)
        for words, runs in zip(docs, got):
            assert runs == walked(words, exponent, least)
            assert R.collapse(words, runs) == left_over(words, runs)


def test_long_texts():
    assert R.runs_of([[b"a"] * 100_000, [], [b"x", b"y"] * 20_000 + [b"z"]]) == [[(0, 100_000, 1)], [], [(0, 40_000, 2)]]
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 3_000:
        a, b = b, b + a
    assert R.runs_of([b], 2, 2) == [walked(b, 2, 2)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = walked(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(left_over(words, runs))).hexdigest(),
    )


def test_digest(spark, odd, odd_rows, nothing):
    rng = random.Random(3)
    more = [(i, " ".join(w.decode() for w in drawn(rng, 4, rng.randrange(120)))) for i in range(100, 260)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [(r[0], r[1]) for r in odd_rows if r[0] not in (8, 9)] + more
    got = [tuple(r) for r in R.digest(docs.where("doc_id is null or doc_id not in (8, 9)")).collect()]
    assert sorted(map(repr, got)) == sorted(repr(expected(*r)) for r in rows)
    assert sum(r[1] for r in got) > 20
    assert R.digest(odd).count() == len(odd_rows)
    assert R.digest(nothing).collect() == []


def test_collapsed_keeps_columns(spark, odd, nothing):
    assert R.collapsed(odd).columns == odd.columns
    assert R.collapsed(nothing).collect() == []
    rows = [(1, "x  y " + "a b\n" * 5 + "z", 7), (2, "as  it was", 8), (3, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs long")
    assert [tuple(r) for r in R.collapsed(docs).orderBy("doc_id").collect()] == [
        (1, "x y a b z", 7), (2, "as  it was", 8), (3, None, 9),
    ]
