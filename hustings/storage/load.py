"""Normalized rows -> provenance -> schema -> repeats removed -> checked -> stored
-> recorded."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DatasetUnavailableError, HustingsError, ValidationError
from ..operators import quality
from ..operators.elections import race_summary
from ..operators.pit import clip_estimated
from ..operators.relational import keep_last
from ..schema import enforce_schema, table_spec
from ..session import materialize
from ..sources.registry import SourceSpec, get_spec
from .lake import Lake
from .manifest import Manifest, RunRecord, last_success, next_run_id

KEEP_LAST_ORDER = ("publication_date", "revision_vintage")


@dataclass
class LoadResult:
    dataset_id: str
    run_id: str
    status: str
    rows: int = 0
    dropped: int = 0
    error: str | None = None
    notes: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return self.status == "success"


def add_provenance(
    df: DataFrame,
    spec: SourceSpec,
    *,
    retrieval_date: dt.date,
    run_id: str,
    source_url: str | None = None,
) -> DataFrame:
    """Constant provenance columns; estimated release days clipped to retrieval."""
    have = set(df.columns)
    held = F.lit(retrieval_date)
    estimated = F.lit(False)
    if "publication_date_estimated" in have:
        estimated = F.coalesce("publication_date_estimated", F.lit(False))
    values = {
        "source": F.lit(spec.source),
        "dataset_id": F.lit(spec.id),
        "retrieval_date": held,
        "ingestion_run_id": F.lit(run_id),
        "publication_date_estimated": estimated,
    }
    if "source_url" not in have:
        values["source_url"] = F.lit(source_url).cast("string")
    if "observation_date" not in have and "period_end" in have:
        values["observation_date"] = F.col("period_end")
    if "publication_date" in have:
        values["publication_date"] = clip_estimated(
            F.col("publication_date").cast("date"), estimated, held
        )
    return df.withColumns(values)


def prepare(
    df: DataFrame, spec: SourceSpec, *, retrieval_date: dt.date, run_id: str
) -> DataFrame:
    """Canonical rows, the newest one per natural key."""
    table = table_spec(spec.table)
    canonical = enforce_schema(
        add_provenance(df, spec, retrieval_date=retrieval_date, run_id=run_id), table
    )
    return keep_last(canonical, table.key, KEEP_LAST_ORDER)


def load(
    lake: Lake,
    dataset_id: str,
    normalized: DataFrame,
    *,
    retrieval_date: dt.date | None = None,
    fail_on_error: bool = True,
    options: dict[str, str] | None = None,
) -> LoadResult:
    """Store one dataset's normalized rows. Errors found by the rules keep the
    stored data as it was; the outcome is recorded either way."""
    spec = get_spec(dataset_id)
    manifest = Manifest(lake)
    started = dt.datetime.now(dt.UTC)
    held = retrieval_date or started.date()
    record = RunRecord(
        next_run_id(spec.id), spec.source, spec.id, started,
        retrieval_date=held, normalized_table=spec.table, options=dict(options or {}),
    )
    result = LoadResult(spec.id, record.run_id, "running")
    try:
        if not spec.runnable:
            record.status, record.error = "skipped", f"dataset status is {spec.status}; no loader"
        else:
            _store(lake, spec, normalized, held, record, result, manifest, fail_on_error)
            record.status = "success"
    except HustingsError as exc:
        record.status, record.error = "failed", f"{type(exc).__name__}: {exc}"
    except Exception as exc:  # a failing task surfaces here; it is recorded as well
        record.status, record.error = "failed", f"{type(exc).__name__}: {exc}"
    finally:
        record.completed_at = dt.datetime.now(dt.UTC)
        manifest.append(record)
    result.status, result.error, result.notes = record.status, record.error, tuple(record.notes)
    return result


def _store(lake, spec, normalized, held, record, result, manifest, fail_on_error) -> None:
    # Read by the checks, the count and the write: computed once, kept on shared
    # storage, so that losing an executor does not repeat the parse.
    received = materialize(normalized, f"received-{spec.id}")
    rows = materialize(
        prepare(received, spec, retrieval_date=held, run_id=record.run_id), f"load-{spec.id}"
    )
    count = rows.count()
    if count == 0:
        raise DatasetUnavailableError(f"{spec.id}: no rows")
    issues = [
        row.asDict()
        for row in quality.validate(rows, spec.table, dataset=spec.id, source=spec.source).collect()
    ]
    errors = [i for i in issues if i["severity"] == "error"]
    record.validation_errors = len(errors)
    record.validation_warnings = len(issues) - len(errors)
    record.validation_issues = [
        {k: str(v) for k, v in issue.items() if v is not None} for issue in issues
    ]
    before = last_success(manifest.newest(), spec.id).first()
    dropped = received.count() - count
    if dropped:
        record.notes.append(f"{dropped} rows repeated the natural key of a newer row and were dropped")
    result.dropped = dropped
    if before is not None and before.row_count:
        note = quality.row_count_drift(F.lit(before.row_count), F.lit(count)).alias("note")
        drift = rows.sparkSession.range(1).select(note).first().note
        if drift:
            record.notes.append(drift)
    if errors and fail_on_error:
        raise ValidationError(f"{len(errors)} validation errors (first: {errors[0]['message']})")
    record.processed_path = lake.write_processed(rows, spec.table, spec.id)
    record.row_count = result.rows = count


def rebuild_race_summary(lake: Lake) -> quality.ValidationReport:
    """Recompute and store the derived race summaries; issues are reported but
    never block."""
    summary = materialize(race_summary(lake.read_table("election_results")), "race-summary")
    lake.write_processed(summary, "election_race_summary", "derived")
    return quality.validate_table(
        summary, "election_race_summary", dataset="derived", source="transform"
    )


def validate_store(lake: Lake, *, fail_on_warning: bool = False) -> tuple[DataFrame, bool]:
    """All rules over every stored table and dataset: the issues, and whether the
    store passes. One pass per table, by dataset, however many datasets it holds."""
    parts = [quality.validate(lake.read_table(name), name, per="dataset_id") for name in lake.tables()]
    if not parts:
        raise DatasetUnavailableError("the store holds no tables")
    issues = parts[0]
    for part in parts[1:]:
        issues = issues.unionByName(part)
    blocking = issues if fail_on_warning else issues.where(F.col("severity") == "error")
    return issues, blocking.isEmpty()
