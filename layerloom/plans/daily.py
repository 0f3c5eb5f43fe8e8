"""One daily run: the stages as plain function calls, in their fixed order."""

from __future__ import annotations

from layerloom.context import RunContext
from layerloom.plans.gold import load_gold
from layerloom.plans.ingest import Sources, land, load_bronze
from layerloom.plans.lake import AuditRow, Lake
from layerloom.plans.silver import load_silver


def run_daily(
    lake: Lake, sources: Sources, run: RunContext, *, severity_aware: bool = False
) -> list[AuditRow]:
    """Land, refine and validate every active table, then rebuild gold."""
    rows = []
    for config in lake.metadata.active_tables():
        rows.append(land(lake, config, sources, run))
        rows.append(load_bronze(lake, config, run))
        rows.append(load_silver(lake, config, run, severity_aware=severity_aware))
    return rows + load_gold(lake, run)
