"""All-or-nothing publishing: complete versions beside each other and a log of commits.

Each export is written into a directory of its own. Only when everything is written is a commit created that names
it: a small numbered file, created only if its number is free. The highest number is the current version, so
readers always see one whole version, and of two publishers at once each gets a number of its own: the one that
finds its number taken takes the next. Nothing is renamed or overwritten, which object stores cannot do in one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from hazardmarts.sources import files

COMMITS = "commits"
VERSIONS = "versions"


@dataclass(frozen=True)
class Commit:
    number: int
    version: str


def publish(
    spark: SparkSession, export_dir: str, write: Callable[[str], None], label: str, keep: int | None = None
) -> str:
    """Run ``write(directory)`` on a fresh directory and make it the current version.

    When it raises, the directory is removed and the current version stays. All versions are kept, unless
    ``keep`` says how many of the newest are; the one that was current before is never removed, nor one that another
    publisher is still writing. Commits stay as the history.
    """
    version = f"{label}-{uuid.uuid4().hex[:12]}"
    target = f"{export_dir}/{VERSIONS}/{version}"
    try:
        write(target)
    except BaseException:
        files.remove(spark, target)
        raise
    number = commit(spark, export_dir, version)
    if keep is not None:
        _retire(spark, export_dir, number, max(keep, 1))
    return target


def commit(spark: SparkSession, export_dir: str, version: str) -> int:
    """Append a commit for a version that is whole; returns its number."""
    number = max(_numbers(spark, export_dir), default=0) + 1
    while not files.create_once(spark, _path(export_dir, number), json.dumps({"version": version}) + "\n"):
        number += 1
    return number


def history(spark: SparkSession, export_dir: str) -> list[Commit]:
    """All commits in order."""
    return [_read(spark, export_dir, number) for number in _numbers(spark, export_dir)]


def current(spark: SparkSession, export_dir: str) -> str | None:
    """Directory of the current version, or None before the first publication."""
    numbers = _numbers(spark, export_dir)
    return f"{export_dir}/{VERSIONS}/{_read(spark, export_dir, numbers[-1]).version}" if numbers else None


def _path(export_dir: str, number: int) -> str:
    return f"{export_dir}/{COMMITS}/{number:012d}.json"


def _numbers(spark: SparkSession, export_dir: str) -> list[int]:
    names = files.children(spark, f"{export_dir}/{COMMITS}", directories=False)
    return sorted(int(stem) for stem, _, kind in (n.partition(".") for n in names) if kind == "json" and stem.isdigit())


def _read(spark: SparkSession, export_dir: str, number: int) -> Commit:
    return Commit(number, json.loads(files.read_text(spark, _path(export_dir, number)))["version"])


def _retire(spark: SparkSession, export_dir: str, number: int, keep: int) -> None:
    """Remove the versions of commits older than the newest ``keep`` and than the one before ``number``."""
    root = f"{export_dir}/{VERSIONS}"
    there = set(files.children(spark, root, directories=True))
    commits = [c for c in history(spark, export_dir) if c.version in there]
    for old in commits[: max(len(commits) - keep, 0)]:
        if old.number < number - 1:
            files.remove(spark, f"{root}/{old.version}")
