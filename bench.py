"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from hustings.plans import QUERIES
from hustings.session import clean_scratch, local_session

HEADLINE = (
    "ele01_race_summary",
    "ele04_presidential_lean",
    "ele06_political_history_house",
    "trn01_turnout_metrics",
    "pit02_latest_as_of",
    "dem02_population_as_of",
    "eco01_unemployment_features",
    "eco02_industry_shares",
    "eco04_national_features",
    "can02_finance_senate",
    "pol02_approval_features",
    "pol04_race_polls_senate",
    "fea01_build_features_senate",
    "dq12_validate_table",
    "nrm01_normalize_returns",
    "join04_asof_inclusive",
    "api08_results_by_race",
    "exp03_national_totals_president",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    # Start the executors and warm up the file listing before the clock runs.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
