"""The pipeline and the registered queries."""

import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from hustings.llm import common, queries, token_files
from hustings.llm.common import BATCH_BYTES, documents


def test_stages_on_odd_rows(spark, odd, nothing, sf_dir):
    for docs in (odd, nothing):
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == columns
                docs = out
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert out.count() == docs.count()


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts, before = [], docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before = stage(spark, before, sf_dir)
        counts.append(before.count())
    assert docs.count() >= counts[0] > counts[1] >= counts[2] > 0


def test_run_repeats(spark, sf_dir):
    first = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert first == sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert first[0][1] == 0


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in names) for r in df.collect())
    assert got == sorted(tuple(map(repr, row)) for row in cursor.fetchall())


def test_batches_are_bounded(spark, sf_dir):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    def taken():
        documents(spark, sf_dir)
        rows = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 100000) as text")
        found = rows.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in found) == 400
        return max(r.bytes for r in found)

    try:
        spark.conf.set(name, "64m")
        assert taken() <= BATCH_BYTES + 200_000
        spark.conf.set(name, "1m")  # a lower bound stays
        assert taken() <= (1 << 20) + 200_000
        spark.conf.set(name, "300b")  # a row is never cut
        assert 100_000 <= taken() <= 200_000
    finally:
        spark.conf.set(name, before)


def test_scans_decode_few_rows_at_once(spark, sf_dir):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "4096")
        documents(spark, sf_dir)
        assert int(spark.conf.get(name)) == common.SCAN_ROWS
        spark.conf.set(name, "16")  # a lower bound stays
        documents(spark, sf_dir)
        assert int(spark.conf.get(name)) == 16
    finally:
        spark.conf.set(name, before)


def test_few_rows_need_no_python(spark):
    for rows in ([(1, 5), (2, 1 << 40)], []):
        df = common.few(spark, rows, "part int, base bigint")
        assert [tuple(r) for r in df.collect()] == rows
        assert df.dtypes == [("part", "int"), ("base", "bigint")]
        assert "PythonRDD" not in df._jdf.rdd().toDebugString()


def test_workers_give_back(monkeypatch):
    done = []
    monkeypatch.setattr(common, "give_back", lambda: done.append("given"))

    def twice(batches):
        for b in batches:
            yield from (b, b)
        done.append("read")

    assert list(common.giving_back(twice)(iter([1, 2]))) == [1, 1, 2, 2]
    assert done == ["read", "given"]
    token_files._encoder(token_files.public_path())
    list(token_files._reader(iter([])))
    assert token_files._encoder.cache_info().currsize == 0
