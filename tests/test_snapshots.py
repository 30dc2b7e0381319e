"""Several stored retrievals, and rows that caps used to lose."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hustings.api.platform import Platform
from hustings.operators import candidates as C
from hustings.operators import economics as E
from hustings.operators import elections as L
from hustings.operators import features as X
from hustings.operators import pit
from hustings.operators import quality as Q
from hustings.plans import QUERIES
from hustings.sources import readers

D = dt.date


def test_snapshot_as_of(spark):
    rows = [("a", D(2000, 1, 1), 1), ("a", D(2000, 7, 1), 2), ("a", D(2001, 7, 1), 3), ("b", D(2001, 1, 1), 4), ("b", D(2001, 7, 1), 5)]
    df = spark.createDataFrame(rows, "k string, retrieval_date date, v int")
    at = lambda day: {r.k: r.v for r in pit.snapshot_as_of(df, day, ["k"]).collect()}
    assert at("2000-10-20") == {"a": 2, "b": 4}  # of b nothing that old is held: the oldest
    assert at("2001-12-31") == at(None) == {"a": 3, "b": 5}


def labor(spark):
    rows = [("PA", D(2000, 6, 1), True, rate, 10.0, 11.0, D(2000, 7, 1), kept) for rate, kept in ((4.0, D(2000, 7, 1)), (9.0, D(2001, 7, 1)))]
    return spark.createDataFrame(
        rows,
        "state string, date date, seasonally_adjusted boolean, unemployment_rate double, employment double, labor_force double, "
        "publication_date date, retrieval_date date",
    )


def test_later_retrieval_does_not_leak(spark):
    assert E.unemployment_features(labor(spark), "2000-10-20").first().unemployment_rate == 4.0
    assert E.unemployment_features(labor(spark), "2001-10-20").first().unemployment_rate == 9.0
    months = Platform.of_tables({"labor": labor(spark)}).economics.labor(as_of="2000-10-20").collect()
    assert [m.unemployment_rate for m in months] == [4.0]


def test_candidate_counts_once(spark):
    rows = [("C1", "C", D(2000, 3, 1)), ("C1", "I", D(2000, 9, 1)), ("C1", "O", D(2001, 9, 1))]
    df = spark.createDataFrame(
        [(i, 2000, 2000, "PA", "senate", "DEM", s, "C", D(2000, 1, 1), r) for i, s, r in rows],
        "candidate_id string, cycle int, election_year int, state string, office string, party string, "
        "incumbent_challenger_status string, candidate_status string, publication_date date, retrieval_date date",
    )
    row = C.incumbency_features(df, 2000, "senate", "2000-10-20").first()
    assert (row.n_dem_candidates, row.incumbent_party) == (1, "DEM")
    assert C.incumbency_features(df, 2000, "senate", "2000-05-01").first().incumbent_party is None


def test_retrievals_are_no_duplicates(spark):
    found = {r.rule for r in Q.validate(labor(spark), "labor").collect()}
    assert "duplicate_key" not in found
    found = {r.rule for r in Q.validate(labor(spark).unionByName(labor(spark)), "labor").collect()}
    assert "duplicate_key" in found


def test_every_score_cell(spark):
    rows = [("PA", 2000, g, s, 200.0 + g, D(2000, 1, 1)) for g, s in ((4, "reading"), (12, "mathematics"), (4, "science"))]
    naep = spark.createDataFrame(rows, "state string, assessment_year int, grade int, subject string, average_score double, publication_date date")
    row = X.naep_wide(naep, "2000-10-20").first()
    assert (row.naep_read_grade4, row.naep_math_grade12, row.naep_scie_grade4) == (204.0, 212.0, 204.0)


def test_score_columns_have_names_of_their_own(spark):
    cells = [(4, "reading"), (4, "readiness"), (8, "history"), (8, "histology"), (8, "History"), (12, "history"), (8, "hist")]
    rows = [("PA", 2000, g, s, 200.0 + i, D(2000, 1, 1)) for i, (g, s) in enumerate(cells)]
    naep = spark.createDataFrame(rows, "state string, assessment_year int, grade int, subject string, average_score double, publication_date date")
    row = X.naep_wide(naep, "2000-10-20").first().asDict()
    assert len({c.lower() for c in row}) == len(row) == 12
    assert (row["naep_read_grade4"], row["naep_readiness_grade4"], row["naep_hist_grade12"]) == (200.0, 201.0, 205.0)
    assert (row["naep_histology_grade8"], row["naep_hist_grade8"]) == (203.0, 206.0)
    assert sorted(v for c, v in row.items() if c.lower().startswith("naep_history")) == [202.0, 204.0]


def test_registered_builds_check_leakage(spark, sf_dir, monkeypatch):
    checked, check = [], X.verify_no_leakage
    monkeypatch.setattr(X, "verify_no_leakage", lambda families, cut: checked.append(cut) or check(families, cut))
    for office in X.OFFICES:
        QUERIES[f"fea01_build_features_{office}"].run(spark, sf_dir)
    assert checked == [D(2000, 10, 20)] * 3


def test_build_reads_each_table_once(spark, sf_dir, monkeypatch):
    """The frame is a plan over stored passes; each pass has its table once."""
    from hustings.operators import slices as S
    from hustings.plans import core
    from hustings.plans.registry import Tables

    passes, store = [], S.materialize

    def watched(df, purpose):
        passes.append((purpose, df._jdf.queryExecution().optimizedPlan().toString()))
        return store(df, purpose)

    monkeypatch.setattr(S, "materialize", watched)
    tables = Tables(spark, sf_dir).many(core.FEATURE_TABLES)
    once = {}
    for name, df in tables.items():
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/once/{name}"
        df.limit(50).write.mode("overwrite").parquet(path)
        once[name] = spark.read.parquet(path)
    build = X.build_features(once, core.YEAR, "senate", core.AS_OF)
    assert len(passes) == len(S.PASSES) and all(p.count("] parquet") == 1 for _, p in passes)
    assert not any("/once/" in f for f in build.frame.inputFiles())
    assert not any("/once/" in f for f in build.families.inputFiles())


def test_slices_give_the_features_of_whole_tables(spark, sf_dir):
    from hustings.operators import candidates as C, demographics as DM, polls as P, slices as S
    from hustings.plans import core
    from hustings.plans.registry import Tables

    cut = D(2000, 10, 20)
    tables = Tables(spark, sf_dir).many(core.FEATURE_TABLES)
    cuts = {name: S.take(name, tables[name], 2000, "senate", cut) for name in S.PASSES}
    pairs = {
        "labor": lambda t: E.unemployment_features(t, cut),
        "national_economy": lambda t: E.national_features(t, cut),
        "state_economy": lambda t: E.state_economy_features(t, cut),
        "population": lambda t: DM.population_as_of(t, cut),
        "demographics": lambda t: DM.demographics_as_of(t, cut),
        "candidates": lambda t: C.incumbency_features(t, 2000, "senate", cut),
        "candidate_finance": lambda t: C.finance_features(t, 2000, "senate", cut),
        "polls": lambda t: P.race_poll_features(t, 2000, "senate", cut),
        "approval_polls": lambda t: P.approval_features(t, cut),
        "generic_ballot_polls": lambda t: P.generic_ballot_features(t, cut),
        "special_elections": lambda t: P.special_election_swing(t, cut),
        "naep": lambda t: X.naep_wide(t, cut),
    }
    for name, features in pairs.items():
        text = lambda df: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
        whole, cut_rows = features(tables[name]), features(cuts[name].rows)
        assert whole.columns == cut_rows.columns and text(whole) == text(cut_rows), name
    # Provenance from the passes is that of the rows themselves.
    for family in ("labor", "race_polls", "incumbency", "national_economy"):
        rows = X.family_rows(tables, tables["election_results"].withColumn("special", F.lit(False)), 2000, "senate", cut)[family]
        want = X.family_provenance(family, rows, spark).first()
        assert S.provenance({family: cuts[X.FAMILIES[family]].facts}, {}, spark).first() == want


def test_every_measure(spark):
    rows = [("m7", D(2000, 1, 1), None, 7.0, D(2000, 2, 1)), ("cpi_core", D(2000, 1, 1), True, 1.0, D(2000, 2, 1))]
    df = spark.createDataFrame(rows, "measure string, date date, seasonally_adjusted boolean, value double, publication_date date")
    wide = Platform.of_tables({"national_economy": df}).economics.national(as_of="2000-10-20", wide=True)
    assert wide.first().m7_nsa == 7.0
    accounts = spark.createDataFrame([("PA", 1999, "new_measure", 3.0, D(2000, 1, 1))], "state string, year int, measure string, value double, publication_date date")
    assert E.state_economy_features(accounts, "2000-10-20").first().new_measure == 3.0


def test_publication_column_of_nulls(spark):
    df = spark.createDataFrame([(1, None, D(2000, 1, 1)), (2, None, D(2001, 1, 1))], "v int, publication_date date, retrieval_date date")
    assert pit.filter_as_of(df, "2000-10-20").count() == 0
    assert [r.v for r in pit.filter_as_of(df, "2000-10-20", resolve=True).collect()] == [1]


def test_cells_of_a_response(spark):
    bodies = spark.createDataFrame([("f", '[["h"],["1"],["2"]]'), ("g", "[]"), ("h", '[["h"]]')], "file string, value string")
    assert sorted(r.value for r in readers.parse_acs_cells(bodies).collect()) == ["1", "2"]


def test_file_years_and_headers(spark, tmp_path):
    for name, text in {"y2001/a.csv": "x,y\n1,2\n", "y1999/b.csv": "x,y\n3,4\n", "y1999/c.csv": "y,z\n5,6\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    years = readers.with_file_year(readers.read_csv(spark, [str(tmp_path / "y2001"), str(tmp_path / "y1999/b.csv")]))
    assert sorted((r.x, r.year) for r in years.collect()) == [("1", 2001), ("3", 1999)]
    (tmp_path / "all").mkdir()
    for i, text in enumerate(("x,y\n1,2\n", "x,y\n3,4\n", "y,z\n5,6\n")):
        (tmp_path / f"all/{i}.csv").write_text(text)
    df = readers.read_manual_csvs(spark, str(tmp_path / "all"))
    assert sorted((r.x or "", r.y, r.z or "") for r in df.collect()) == [("", "5", "6"), ("1", "2", ""), ("3", "4", "")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # one scan per different header


def test_folder_stays_when_a_write_fails(spark, tmp_path):
    from hustings import Lake

    lake, path = Lake(spark, str(tmp_path)), f"{tmp_path}/t"
    rows = lambda: lake.read_parquet(path).count()
    spark.range(2).write.parquet(path)  # without versions
    assert rows() == 2
    lake.write_parquet(spark.range(3), path)
    before = lake.read_parquet(path)
    assert before.count() == 3
    lake.write_parquet(spark.range(5), path)
    # A reader that opened the version before still has its files; new readers see the new one.
    assert before.count() == 3 and rows() == 5
    with pytest.raises(Exception):
        lake.write_parquet(spark.range(9).select(F.raise_error(F.lit("no"))), path)
    assert rows() == 5
    # Data without a commit is no version.
    spark.range(7).write.parquet(f"{path}/data-000000000099-x")
    assert rows() == 5
    lake.write_parquet(spark.range(6), path)
    lake.write_parquet(spark.range(8), path)
    assert rows() == 8
    names = [n for n in lake.children(path) if n != "data-000000000099-x"]
    assert len([n for n in names if n.startswith("data-")]) == 2 and len(names) == 3
    assert len(lake.children(f"{path}/_commits")) == 2


def test_readers_see_the_old_or_the_new_folder(spark, tmp_path):
    """Reads between all steps of a replacement give either the old rows or the new ones."""
    from hustings import Lake

    class Watched(Lake):
        seen: list[int] = []

        def _files(self, path):
            if "_commits" in path and self.exists_plain(f"{tmp_path}/t"):
                self.seen.append(Lake(spark, str(tmp_path)).read_parquet(f"{tmp_path}/t").count())
            return super()._files(path)

        def exists_plain(self, path):
            location, system = Lake._files(self, path)
            return system.exists(location)

    lake = Watched(spark, str(tmp_path))
    Lake(spark, str(tmp_path)).write_parquet(spark.range(3), f"{tmp_path}/t")
    lake.write_parquet(spark.range(5), f"{tmp_path}/t")
    assert set(lake.seen) == {3, 5} and lake.seen == sorted(lake.seen)


def test_summary_reads_the_lines_once(spark, tmp_path):
    path = f"{tmp_path}/lines"
    columns = "state string, state_fips string, year int, office string, district string, special boolean, candidate string, party string, votes double"
    race = ("PA", "42", 2000, "senate", "statewide", False)
    rows = [(*race, "A", "DEM", 5.0), (*race, "A", "DEM", 5.0), (*race, "B", "REP", 4.0)]
    rows += [("OH", "39", *race[2:], c, p, v) for c, p, v in (("A", "DEM", 6.0), ("B", "REP", 3.0), ("C", "REP", 2.0))]
    spark.createDataFrame(rows, columns).withColumn("total_votes", F.col("votes")).write.parquet(path)
    summary = L.race_summary(spark.read.parquet(path))
    assert not any(path in f for f in summary.inputFiles())  # the pass over them is done
    got = {r.state: r for r in summary.collect()}
    # A line that stands there twice is its own runner-up.
    assert (got["PA"].dem_votes, got["PA"].n_candidates, got["PA"].winning_margin) == (10.0, 2, 0.0)
    assert (got["OH"].winner_party, got["OH"].winning_margin) == ("DEM", 3.0 / 11.0)
