"""Tables that follow another one month by month.

Source and target are committed tables laid out by year and month. A folder never changes, so a month is up to date while
the source lists the folders that the target's commit notes for it. Only other months are read and written again.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tillstar.sources.commits import Commit, CommittedTable

SOURCES = "sources"


def month_of(folder: str) -> str:
    """The values of a folder's layout, as 2024/3."""
    return "/".join(level.partition("=")[2] for level in folder.split("/")[1:])


def by_month(commit: Commit) -> dict[str, list[str]]:
    found = defaultdict(list)
    for folder, rows in commit.folders.items():
        if rows:
            found[month_of(folder)].append(folder)
    return {month: sorted(folders) for month, folders in found.items()}


def follow(
    source: CommittedTable,
    target: CommittedTable,
    build: Callable[[DataFrame], DataFrame],
    layout: Sequence[str],
    commit: Commit | None = None,
    check: Callable[[DataFrame], dict[str, str]] | None = None,
) -> tuple[Commit, set[str]]:
    """Bring the target up to a commit of the source; returns its commit and the months that were built again.

    ``build`` turns rows of some months into rows of the same months.
    """
    commit, base = commit or source.latest(), target.latest()
    now = by_month(commit)
    then = json.loads(base.notes.get(SOURCES, "{}")) if base else {}
    # What another job wrote without noting its source is built anew.
    same = {month for month, folders in now.items() if then.get(month) == folders}
    changed = set(now) - same
    if base is not None and SOURCES in base.notes and not changed and set(then) == set(now):
        return base, set()
    rows = build(source.read(commit, lambda folder: month_of(folder) in changed))
    keep = lambda folder: month_of(folder) in same
    return target.write(rows, layout, keep=keep, check=check, base=base, extra={SOURCES: json.dumps(now)}), changed
