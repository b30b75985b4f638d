"""Registered views, created in the order of what they read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class View:
    """How a view is made and the names of the registered views that it reads."""

    build: Callable[[], DataFrame]
    reads: Sequence[str] = ()


def dependence_order(reads: Mapping[str, Sequence[str]]) -> tuple[list[str], dict[str, list[str]]]:
    """The names so that each comes after all that it reads, by name where there is a choice; and for each name on a cycle
    the way round. Names that are not registered count as tables that are there."""
    known = {n: sorted({r for r in rs if r in reads}) for n, rs in reads.items()}
    left, order = dict(known), []
    while ready := sorted(n for n, rs in left.items() if not any(r in left for r in rs)):
        order += ready
        left = {n: rs for n, rs in left.items() if n not in ready}
    cycles: dict[str, list[str]] = {}
    for start in sorted(left):
        way, seen = [[start]], set()
        while way and start not in cycles:
            path = way.pop(0)
            for r in (r for r in left[path[-1]] if r in left):
                if r == start:
                    cycles[start] = [*path, start]
                    break
                if r not in seen:
                    seen.add(r)
                    way.append([*path, r])
    return order, cycles


def register(views: Mapping[str, View]) -> list[dict[str, str]]:
    """Create every view that can be, each after what it reads. The report has one entry per view (view, status, error):
    SUCCESS; FAILED with its own error, or with the cycle it is on; SKIPPED with the views below it that are missing."""
    order, cycles = dependence_order({n: v.reads for n, v in views.items()})
    status: dict[str, tuple[str, str]] = {n: ("FAILED", f"reads itself: {' -> '.join(way)}") for n, way in cycles.items()}
    # what reads a cycle without being on it was left out of the order
    for name in [*order, *sorted(n for n in views if n not in order and n not in cycles)]:
        missing = sorted(r for r in views[name].reads if r in views and status.get(r, ("SKIPPED",))[0] != "SUCCESS")
        if missing:
            status[name] = ("SKIPPED", f"not there: {', '.join(missing)}")
            continue
        try:
            views[name].build().createOrReplaceTempView(name)
            status[name] = ("SUCCESS", "")
        except Exception as e:  # noqa: BLE001 - any failure is reported with its view
            status[name] = ("FAILED", str(e))
    return [{"view": n, "status": status[n][0], "error": status[n][1]} for n in sorted(views)]
