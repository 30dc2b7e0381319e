"""Scores, languages, quality, token files, mixing, sharding and site lines."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hustings.llm import class_lm, language, mixing, quality, sharding, site_lines, token_files
from hustings.llm.common import number_copies, running


def held(doc_id, folds, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == k


def test_class_lm(odd, odd_rows, monkeypatch):
    got = class_lm.digest(odd).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter(w for r in odd_rows if not held(r[0], 5, 1) for w in tokens(r[1]))
    total = sum(counts.values())
    chance = lambda w: math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1)))
    want = Counter()
    for r in odd_rows:
        t = tokens(r[1])
        want[(str(r[0]), held(r[0], 5, 1), len(t), sum(w in counts for w in t), total, round(sum(map(chance, t)), 4))] += 1
    assert Counter((str(r[0]), *r[1:5], round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_class_lm_is_a_distribution():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 50, (class_lm.CLASSES, class_lm.CLASSES))
    classes = np.concatenate(([0], rng.integers(1, class_lm.CLASSES, 500)))
    counts = rng.integers(1, 9, 501)
    members = np.bincount(classes, counts, class_lm.CLASSES)
    # Classes without words have no pairs either.
    pairs[:, members == 0] = 0
    model = class_lm.Model(pairs, members, int(counts.sum()), 501, int((counts == 1).sum()))
    for before in (0, 7):
        known = model.chances(np.append(counts[:1] * 0 + 1, counts), np.append([before], classes))
        # The first entry only sets the context of the second; all others are asked one by one.
        each = [model.chances(np.array([1, c]), np.array([before, k]))[1] for c, k in zip(counts, classes)]
        unknown = model.chances(np.array([1, 0]), np.array([before, 3]))[1]
        assert math.isclose(sum(each) + unknown, 1, rel_tol=1e-6)
    assert len(known) == 502


def test_class_lm_beats_the_base(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_BYTES", 3000)  # many chunks and buckets
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        line = [f"{'ab'[j % 2]}{rng.integers(30)}{'xy'[j % 2]}" for j in range(40)]
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    once = {r.doc_id: r for r in class_lm.digest(docs.repartition(3)).collect()}
    tested = [r for r in once.values() if r.held_out]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested) + 0.2 * sum(r.n_tokens for r in tested)
    again = {r.doc_id: r for r in class_lm.digest(docs.repartition(7)).collect()}
    assert all(math.isclose(again[i].score, r.score, rel_tol=1e-9) for i, r in once.items())


def test_class_lm_without_training(spark, nothing):
    assert class_lm.digest(nothing).collect() == []
    out = next(i for i in range(99) if held(i, 5, 1))
    row = class_lm.digest(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (row.train_tokens, row.base_score, row.score, row.n_known) == (0, 0.0, 0.0, 0)


def test_language(odd, nothing):
    got = language.digest(odd).collect()
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "es", "und"}
    found = {r.doc_id: r for r in got}
    for i in (3, 4, 5, 10):  # null, empty, blank, no letter
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2) for r in got)
    kept = language.identified(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert language.digest(nothing).collect() == []
    assert {r.lang_pred for r in language.digest(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("lang", [None, "und"])
def test_language_keeps_letters_without_labels(odd, odd_rows, lang):
    kept = language.identified(odd.withColumn("lang", F.lit(lang).cast("string")))
    assert kept.columns == odd.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows)


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = language.digest(docs).join(docs, "doc_id").where("held_out")
    assert told.where("lang_pred = lang").count() >= 0.97 * told.count()


def test_trigram_vectors_outlive_a_full_store(monkeypatch):
    monkeypatch.setattr(language, "_KEPT", 5000)
    space = language._Space(64, 1)
    text = "".join(chr(0x4E00 + (i * 7919) % 15000) for i in range(9000))
    keys, counts = space.trigrams(text)
    whole = space.bundle(keys, counts)
    again = language._Space(64, 1)
    assert np.allclose(whole, sum(again.bundle(keys[i : i + 10], counts[i : i + 10]) for i in range(0, len(keys), 10)))


def test_quality(spark, odd, nothing, sf_dir):
    labels = spark.createDataFrame([(0, 1), (1, 1), (8, 0), (20, 0), (20, 1), (3, None), (6, 5)], "doc_id long, quality int")
    got = quality.digest(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in got)
    assert {r.score for r in quality.digest(odd, labels.where("false")).collect()} == {0.5}
    assert quality.digest(nothing, labels).collect() == []


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    told = quality.digest(docs, labels).join(labels, "doc_id").where("held_out")
    assert told.where("predicted = quality").count() >= 0.85 * told.count()


def test_quality_scores_by_the_densities():
    rng = np.random.default_rng(0)
    d = len(quality.NAMES)
    x = {0: rng.normal(0, 1, (400, d)), 1: rng.normal(1, 2, (900, d))}
    moments = {k: (h := np.hstack([np.ones((len(v), 1)), v])).T @ h for k, v in x.items()}
    model = quality.Model(moments)
    right = (model.margin(x[1]) > 0).sum() + (model.margin(x[0]) < 0).sum()
    assert right > 0.97 * 1300


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("top", [60_000, 2**32 - 1])
def test_token_file_round_trip(bits, top):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, top, n, endpoint=True).astype("<u4") for n in (0, 1, 300, 0, 77, 1000)]
    names = [None, -5, 7, 7, 2**60, 9]
    data = token_files.pack(names, docs, block_ids=64, bits=bits)
    file = token_files.TokenFile(data)
    start = 0
    for (name, at, ids), own, doc in zip(file.documents(), names, docs, strict=True):
        assert (name, at) == (own, start) and (ids == doc).all()
        start += len(doc)
    assert (file.block(3) == np.concatenate(docs)[192:256]).all()  # one block without the others
    with pytest.raises((ValueError, Exception)):
        token_files.TokenFile(data[:-40] + bytes(40)).block(len(file.index) - 1)
    assert list(token_files.TokenFile(token_files.pack([], [])).documents()) == []


def test_token_files(odd, odd_rows, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.public_path())
    files = token_files.store(odd, token_files.public_path(), file_ids=500, block_ids=64)
    assert files.count() > 5
    got = sorted(token_files.read_index(files).collect(), key=lambda r: r.start)
    start = 0
    for r, (doc_id, text) in zip(got, sorted(((r[0], r[1]) for r in odd_rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.digest(nothing).collect() == []


def test_encoder_agrees_on_odd_texts():
    import random

    rng = random.Random(2)
    encoder = token_files._Encoder(token_files.public_path())
    texts = ["it's don't WE'LL.", "<|endoftext|>. <|ENDOFTEXT|> a<|startoftext|>!", "İ. ǅ. ﬁ! e̲.", "a\x1cb !\x1c! \x85\xa0 x　y"]
    texts += ["".join(rng.choice("aZé.,!'<|>0 ́\x1c#%\n") for _ in range(60)) for _ in range(300)]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_takes_arrow_and_ends():
    encoder = token_files._Encoder(token_files.public_path())
    texts = ["skipped", "One two.", None, "", " \t", "<|endoftext|> TWO... a.\x0b", "two"]
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        got = encoder.ids(pa.array(texts, kind)[1:], 7)
        assert [g.tolist() for g in got] == [w + [7] for w in whole[1:]]
    assert [g.tolist() for g in encoder.ids(texts)] == whole
    assert encoder.ids([]) == []


def test_latin_words_go_to_the_model():
    class ModelOnly:
        def __init__(self, whole):
            self.model = whole.model

    encoder = token_files._Encoder(token_files.public_path())
    letters = [chr(c) for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7, 0x130)]
    words = [w for c in letters for w in (c, f"a{c}b", f"{c}{c}É", f"ZE{c}")]
    wanted = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    encoder.tokenizer = ModelOnly(encoder.tokenizer)
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder.ids(words)] == wanted


def test_encoder_keeps_words_in_use(monkeypatch):
    monkeypatch.setattr(token_files, "_WORDS", 200)
    encoder, learned = token_files._Encoder(token_files.public_path()), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learned.extend(words), learn(words)))
    for i in range(40):
        text = " ".join([f"common{k}" for k in range(30)] + [f"rare{i}x{k}" for k in range(20)])
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert learned.count(b"common7") == 1 and len(learned) == 30 + 40 * 20
    assert len(encoder.words) + len(encoder.older) <= 200


def wanted_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = dict(zip(names, [5, 2, 1] * len(names)))
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not above:
            return out | {s: level * weights[s] for s in open_}
        out |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return out


def test_mixing(odd, odd_rows, nothing):
    options = {"block_words": 500, "shard_words": 2000}
    mix = mixing.Mix(odd.select("doc_id", "source", "text"), **options)
    got = mix.drawn(mix.sized).collect()
    sizes = defaultdict(int)
    for r in odd_rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    targets = wanted_targets(sizes)
    taken, least = defaultdict(int), defaultdict(lambda: 10**9)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert len(r.shards) <= 2
        taken[r.source] += len(r.shards) * r.size
        least[r.source] = min(least[r.source], r.size or 10**9)
    assert len(got) == len(odd_rows) and mix.shards > 8
    quotas = mix.quotas.groupBy("rank").sum("quota").collect()
    assert len(quotas) == len(sizes)
    for source in sizes:
        longest = max(len((r[1] or "").encode().split()) for r in odd_rows if r[3] == source)
        assert abs(taken[source] - targets[source]) <= longest
    again = mixing.Mix(odd.select("doc_id", "source", "text").repartition(3), **options)
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.shards)
    assert sorted(map(key, got)) == sorted(map(key, again.drawn(again.sized).collect()))
    out = mixing.mixed(odd, **options)
    assert out.columns == odd.columns and out.count() == sum(len(r.shards) for r in got)
    assert mixing.digest(nothing).collect() == [] and mixing.mixed(nothing).collect() == []


def test_mixing_deals_equal_rows_one_by_one(spark):
    rows = [(1, " ".join(["w"] * 120), "a")] * 5000 + [(10 + i, " ".join(["v"] * (40 + i % 90)), "b") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ab"}
    want = wanted_targets(sizes)
    taken = Counter()
    first = mixing.digest(docs).collect()
    for r in first:
        assert r.taken <= 2 * r.size
        taken[r.source_size] += r.taken
    assert abs(taken[sizes["a"]] - want["a"]) <= 120 and abs(taken[sizes["b"]] - want["b"]) <= 130
    again = mixing.digest(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.taken, r.shards)
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert mixing.mixed(docs).groupBy("source").count().where("source = 'a'").first()["count"] * 120 == taken[sizes["a"]]


def test_number_copies(spark):
    rows = [("a", 1)] * 400 + [(None, 2)] * 3 + [("b", 3), ("c", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = defaultdict(list)
    for r in number_copies(df, ["k", "v"], "copy").collect():
        got[r.k, r.v].append(r["copy"])
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in Counter(rows).items()}


def test_splitting_tree_keeps_quotas(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TREE_DEPTH", 2)  # several calls
    quotas = {0: 1000, 1: 37, 2: 1, 3: 0}
    rows = mixing.shard_quotas(spark.createDataFrame(list(quotas.items()), "rank long, quota long"), 13).collect()
    by_source, by_shard = defaultdict(int), defaultdict(int)
    for r in rows:
        by_source[r["rank"]] += r.quota
        by_shard[r.shard] += r.quota
    assert dict(by_source) == {k: v for k, v in quotas.items() if v}
    assert set(by_shard) == set(range(13)) and max(by_shard.values()) - min(by_shard.values()) <= 4


def test_running(spark):
    rows = [(i % 7, i, i * i) for i in range(200)]
    frame = spark.createDataFrame(rows, "a int, b int, v long").repartition(6)
    got = running(frame, ["a", "b"], {"before": "v"}, rank="at").collect()
    total = 0
    for at, r in enumerate(sorted(got, key=lambda r: (r.a, r.b))):
        assert (r.at, r.before) == (at, total)
        total += r.v


def test_sharding(odd, nothing):
    names = sharding.shard_names(7)
    owner = sharding.fill(names, 101)
    # The same by the definition: permutations listed in full, turns taken one by one.
    lists = []
    for n in names:
        offset, step = sharding._number(n, "offset") % 101, sharding._number(n, "step") % 100 + 1
        lists.append([(offset + j * step) % 101 for j in range(101)])
    want, turn = [-1] * 101, 0
    while -1 in want:
        i = turn % 7
        want[next(s for s in lists[i] if want[s] < 0)] = i
        turn += 1
    assert owner == want
    shares = Counter(owner)
    assert max(shares.values()) - min(shares.values()) <= 1
    fewer = sharding.fill(names[:-1], 101)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 30
    got = sharding.digest(odd).collect()
    table = sharding.fill(sharding.shard_names(), sharding.SLOTS)
    assert len(got) == odd.count() and all(table[r.slot] == r.shard for r in got)
    assert len({r.slot for r in got if r.doc_id is None}) == 1
    assert sharding.digest(nothing).collect() == []
    with pytest.raises(ValueError):
        sharding.fill(names, 100)
    with pytest.raises(ValueError):
        sharding.place(odd, F.col("doc_id"), names)
    plan = sharding.digest(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_site_lines(spark):
    page = "<html><p>Menu</p><p>same</p><br>text {} <b>x</b><script>Menu()</script></html>"
    rows = [(i, "http://A.example/p", page.format(i)) for i in range(10)]
    rows += [(20, "https://b.example:80/", page.format("b")), (21, None, page.format("n")), (22, "no url", "<p>Menu"), (23, "http://a.example", None),
             (24, "http://a.example", ""), (0, "http://A.example/p", page.format(0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in site_lines.digest(pages).collect()}
    kept = lambda i: [x for x in got[i].text.split("\n") if x]
    assert kept(3) == ["text 3 x"] and got[3].host == "a.example" and got[3].n_dropped == 2
    assert kept(20) == ["Menu", "same", "text b x"] and got[21].host is None and kept(22) == ["Menu"]
    assert got[23].text is None and got[23].n_lines == 0 and got[24].text == ""
    assert site_lines.digest(pages.where("false")).collect() == []
    extra = site_lines.strip(pages.withColumn("key", F.lit(1)).withColumn("_row", F.lit(2)))
    assert extra.count() == len(rows) and {"key", "_row"} <= set(extra.columns)


def test_site_lines_of_small_hosts_and_taken_names(spark):
    rows = [(1, "http://s.example/a", "<p>Menu<p>one"), (2, "http://s.example/b", "<p>Menu<p>two"), (3, "http://t.example/", "<p>Menu<p>Menu")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: [x for x in r.text.split("\n") if x] for r in site_lines.digest(pages).collect()}
    assert got == {1: ["one"], 2: ["two"], 3: ["Menu", "Menu"]}  # one page repeats no line
    for name in ("host", "Host", "TEXT", "n_lines"):
        with pytest.raises(ValueError):
            site_lines.strip(pages.withColumn(name, F.lit(1)))
    with pytest.raises(ValueError):
        sharding.place(pages.withColumn("Slot", F.lit(1)), F.col("page_id"), ["a", "b"])
    with pytest.raises(ValueError):
        language.predict(pages.withColumn("Score", F.lit(1)), {}, text_col="html")
    long = spark.createDataFrame([(1, "http://u.example/", "<p>x" + "<script" * 30_000 + "<!--" * 30_000)], pages.schema)
    assert site_lines.digest(long).first().text == "\nx\n"
