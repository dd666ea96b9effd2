"""Parse: raw feed rows of many loads to landing rows, rejects and statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sellthrough.operators.classify import annotate
from sellthrough.operators.summary import (
    Parsed, file_stats, load_stats, reject_rows, summarise, used_rows, violations,
)
from sellthrough.session import materialise


def window_weeks(loads: DataFrame) -> int:
    """Weeks over all load windows: the most lines (load, week) can have."""
    weeks = F.sum(F.floor(F.date_diff("window_end", "window_start") / 7) + 1)
    return int(loads.agg(weeks).first()[0] or 0)


def derive(annotated: DataFrame, summary: DataFrame, files: DataFrame, loads: DataFrame, weeks_bound: int) -> Parsed:
    """All parse results from judged rows and their summary, which the caller may have written first."""
    return Parsed(annotated, summary, used_rows(annotated, summary, weeks_bound), reject_rows(annotated),
                  file_stats(summary, files), load_stats(summary, files), violations(summary, files, loads))


def parse_feed(raw: DataFrame, files: DataFrame, loads: DataFrame, *, files_bound: int | None = None,
               weeks_bound: int | None = None, keep_rows: bool = True) -> Parsed:
    """Parse a batch. `files` and `loads` hold one row per file and per load; without given bounds they are counted.

    The judged rows are written to a work table once and everything is derived from there: they serve the summary, the
    output and the rejects, and a filter on their status would otherwise be pushed down into the raw text, parsing each
    cell again for the filter. Without `keep_rows` nothing is written: for statistics alone, which are one aggregate over the
    judged rows and need no raw text."""
    files_bound = files.count() if files_bound is None else files_bound
    weeks_bound = window_weeks(loads) if weeks_bound is None else weeks_bound
    annotated = annotate(raw, files, loads, files_bound)
    if keep_rows:
        annotated = materialise(annotated, "parsed")
    return derive(annotated, summarise(annotated), files, loads, weeks_bound)


def check_violations(parsed: Parsed) -> None:
    """Strict mode: raise when any load of the batch fails. Reads the message of one load only."""
    first = parsed.violations.orderBy("load_id").limit(1).collect()
    if first:
        raise ValueError(f"{first[0].load_id}: {first[0].message}")
