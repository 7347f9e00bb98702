"""The registry of queries: a Spark job over the star tables, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tieweave.plans.star_sql import with_views
from tieweave.plans.workspace import Workspace, workspace

Job = Callable[[Workspace], DataFrame]
JOBS: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Job], Job]:
    """Registers a job under its own or the given name, with its SQL if it has any."""

    def register(job: Job) -> Job:
        key = name or job.__name__
        JOBS[key] = job
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return job

    return register


def run(name: str, spark: SparkSession, directory: str) -> DataFrame:
    return JOBS[name](workspace(spark, directory))
