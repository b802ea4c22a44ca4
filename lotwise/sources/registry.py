"""Signal sources by name.  A source is a function that turns landed files into signals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.parties import notices_of_releases
from lotwise.operators.signals import latest_per_key, newest_first, signals_of_notices
from lotwise.sources.deadlines import read_deadlines
from lotwise.sources.jobs import job_ads, job_signals, read_jobs
from lotwise.sources.notices import read_checked
from lotwise.sources.ted import read_ted, ted_signals

Source = Callable[[SparkSession, dict[str, str], dt.date, dt.date], DataFrame]
SOURCES: dict[str, Source] = {}


def source(name: str):
    def register(fn: Source) -> Source:
        SOURCES[name] = fn
        return fn
    return register


class UnreadableDocuments(RuntimeError):
    """Some documents of a source are broken; going on would silently leave their notices out."""


def months_of(paths: dict[str, str]) -> list[str] | None:
    """``paths["months"]``, a comma list of publication months, keeps a source from reading the whole corpus."""
    return [m for m in paths["months"].split(",") if m] if paths.get("months") else None


def report_rejects(rejects: DataFrame, path: str | None) -> None:
    """Write unreadable documents beside the results and refuse to go on if there are any."""
    n = rejects.count()
    if n and path:
        rejects.write.mode("overwrite").parquet(path)
    if n:
        raise UnreadableDocuments(f"{n} unreadable documents, see {path or 'rejected_documents'}")


@source("vergabe_dovs")
def _notices(spark, paths, since, as_of):
    deadlines = read_deadlines(spark, paths["deadlines"]) if "deadlines" in paths else None
    releases, rejects = read_checked(spark, paths["vergabe_dovs"], months_of(paths), paths.get("form") == "lines")
    report_rejects(rejects, paths.get("rejects"))
    return signals_of_notices(notices_of_releases(releases), since, as_of, deadlines)


@source("ted")
def _ted(spark, paths, since, as_of):
    return ted_signals(read_ted(spark, paths["ted"]))


@source("ba_jobs")
def _jobs(spark, paths, since, as_of):
    return job_signals(job_ads(read_jobs(spark, paths["ba_jobs"])))


def all_signals(spark: SparkSession, paths: dict[str, str], since: dt.date, as_of: dt.date) -> DataFrame:
    """The union of every source that has a path, one row per source and external id."""
    frames = [fn(spark, paths, since, as_of) for name, fn in SOURCES.items() if name in paths]
    if not frames:
        raise ValueError(f"no path for any of {sorted(SOURCES)}")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return latest_per_key(union, ["source", "external_id"], newest_first())
