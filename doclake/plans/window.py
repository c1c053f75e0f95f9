"""One date window, or a back-fill of many, from captures to the transformed zone."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from doclake.functions.windows import check_range
from doclake.operators.events import bodies_discovered, event_lines, ingest_log, run_finished, run_started, transform_log
from doclake.operators.stats import run_gate, run_summary, scope_stats
from doclake.plans.ingest import run_ingest
from doclake.plans.transform import run_transform, transform_events
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.sources.landing import scan_range
from doclake.sources.store import Store


@dataclass(frozen=True)
class WindowResult:
    decisions: DataFrame
    outcomes: DataFrame

    def ingest_summary(self) -> DataFrame:
        return run_summary(scope_stats(self.decisions))

    def transform_summary(self) -> DataFrame:
        return run_gate(run_summary(scope_stats(transform_events(self.outcomes))))


def run_window(
    store: Store,
    captures: DataFrame,
    start: date | str,
    end: date | str,
    as_of: str,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> WindowResult:
    """Ingest the captures of [start, end), then transform that range.

    A back-fill is the same call with a wider range: one plan, not one run per window.
    """
    check_range(start, end)
    decisions = run_ingest(store, scan_range(captures, start, end), as_of, profile)
    return WindowResult(decisions, run_transform(store, start, end, as_of, profile))


def run_logged(
    store: Store,
    captures: DataFrame,
    bodies: DataFrame,
    start: date | str,
    end: date | str,
    as_of: str,
    size: str = "monthly",
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """``run_window`` with its log: column ``value``, one JSON line per event of both steps.

    The totals of the ingest are observed by the pass that writes its decisions.
    """
    first, last = check_range(start, end)
    observed: list[Observation] = []
    decisions = run_ingest(store, scan_range(captures, start, end), as_of, profile, observed=observed)
    outcomes = run_transform(store, start, end, as_of, profile)
    ts, started = F.lit(as_of), run_started(store.spark, start, end, size)
    lines = [
        event_lines(started, "run_started", ts, "landing"),
        event_lines(bodies_discovered(bodies), "bodies_discovered", ts, "landing"),
        ingest_log(decisions, ts, summary=run_finished(started, observed[-1].get)),
        transform_log(outcomes, ts, span=f"{first}/{last}"),
    ]
    return reduce(DataFrame.unionByName, lines)
