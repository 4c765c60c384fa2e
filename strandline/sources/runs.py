"""Runs that become visible as a whole.

A run writes all its tables to folders of its own below the zone. An empty marker file, made
when every table is there, makes it the current one; so readers see the tables of the run
before until then, and go on seeing them if the run fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from strandline.session import child_files, child_folders, create_file, delete_path, path_exists

# Names with an underscore, which no table has.
MARKERS, RUNS = "_published", "_runs"


def run_zone(zone: str, run: str) -> str:
    """The zone that holds the tables of one run."""
    return f"{zone.rstrip('/')}/{RUNS}/{run}"


@contextmanager
def whole_run(spark: SparkSession, *zones: str, kept: int = 2) -> Iterator[list[str]]:
    """Zones to write to, one for each of ``zones``; what is there after the block becomes current.

    If the block fails its tables are deleted and nothing changes for a reader. The zones
    get their markers one after another, in the given order: only a crash between these two
    file creations leaves one zone a run ahead of the other, until the next run. Of each
    table the ``kept`` last versions stay, for readers that have begun with an older one.
    """
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    own = [run_zone(zone, run) for zone in zones]
    try:
        yield own
    except BaseException:
        for path in own:
            delete_path(spark, path)
        raise
    for zone in zones:
        _publish(spark, zone, run)
    for zone in zones:
        _forget_old(spark, zone, kept)


def _publish(spark: SparkSession, zone: str, run: str) -> None:
    number = max((n for n, _ in _published(spark, zone)), default=0)
    while True:
        number += 1
        taken = {n for n, _ in _published(spark, zone)}
        # of two runs that end at the same time one takes the next number
        if number not in taken and create_file(spark, f"{zone.rstrip('/')}/{MARKERS}/{number:012d}_{run}"):
            return


def _published(spark: SparkSession, zone: str) -> list[tuple[int, str]]:
    """(number, run) of the published runs, the current one first."""
    names = child_files(spark, f"{zone.rstrip('/')}/{MARKERS}")
    return sorted(((int(n.split("_")[0]), n.split("_")[1]) for n in names), reverse=True)


def versions(spark: SparkSession, zone: str) -> dict[str, list[str]]:
    """Per table that runs have written its paths, the current one first."""
    out: dict[str, list[str]] = {}
    for _, run in _published(spark, zone):
        own = run_zone(zone, run)
        if path_exists(spark, own):
            for table in child_folders(spark, own):
                out.setdefault(table, []).append(f"{own}/{table}")
    return out


def current_path(spark: SparkSession, zone: str, table: str) -> str:
    """Where a table's rows are now: in the last published run that has it, else in the zone itself."""
    for _, run in _published(spark, zone):
        path = f"{run_zone(zone, run)}/{table}"
        if path_exists(spark, path):
            return path
    return f"{zone.rstrip('/')}/{table}"


def current_tables(spark: SparkSession, zone: str) -> dict[str, str]:
    """Names and paths of all tables of a zone."""
    plain = {name: f"{zone.rstrip('/')}/{name}" for name in child_folders(spark, zone)}
    return dict(sorted((plain | {name: paths[0] for name, paths in versions(spark, zone).items()}).items()))


def _forget_old(spark: SparkSession, zone: str, kept: int) -> None:
    old: Sequence[str] = [path for paths in versions(spark, zone).values() for path in paths[kept:]]
    for path in old:
        delete_path(spark, path)
    for number, run in _published(spark, zone):
        if not path_exists(spark, run_zone(zone, run)) or not child_folders(spark, run_zone(zone, run)):
            delete_path(spark, run_zone(zone, run))
            delete_path(spark, f"{zone.rstrip('/')}/{MARKERS}/{number:012d}_{run}")
