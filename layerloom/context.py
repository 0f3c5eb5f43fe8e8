"""Facts that stay fixed during one run: ids, clock and technical column names."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import ClassVar

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TechnicalColumns:
    """Names of the columns the framework adds to business tables."""

    # The technical column names of the data model.
    batch_id: str = "_BatchId"
    run_id: str = "_AdfPipelineRunId"
    ingested_at: str = "_IngestionTimestamp"
    processed_at: str = "_ProcessedTimestamp"
    is_rejected: str = "_IsRejected"
    record_hash: str = "_RecordHash"
    start_date: str = "_StartDate"
    end_date: str = "_EndDate"
    is_current: str = "_IsCurrent"
    surrogate_key: str = "CustomerSK"
    # Ours: the list of rules a row violated.
    failed_rules: str = "_FailedRules"

    # Configuration keys under which the names are stored.
    CONFIG_KEYS: ClassVar[dict[str, str]] = {
        "BATCH_ID_COLUMN": "batch_id",
        "ADF_RUN_ID_COLUMN": "run_id",
        "INGESTION_TIMESTAMP_COLUMN": "ingested_at",
        "PROCESSED_TIMESTAMP_COLUMN": "processed_at",
        "IS_REJECTED_COLUMN": "is_rejected",
        "RECORD_HASH_COLUMN": "record_hash",
        "SCD_START_COLUMN": "start_date",
        "SCD_END_COLUMN": "end_date",
        "SCD_CURRENT_COLUMN": "is_current",
        "SURROGATE_KEY_COLUMN": "surrogate_key",
    }

    @classmethod
    def from_config(cls, config: dict[str, str]) -> "TechnicalColumns":
        """Build the names from (config_name -> config_value) rows."""
        unknown = sorted(set(config) - set(cls.CONFIG_KEYS))
        if unknown:
            raise ValueError(f"unknown technical columns: {unknown}")
        return cls(**{cls.CONFIG_KEYS[k]: v for k, v in config.items()})

    def to_config(self) -> dict[str, str]:
        return {key: getattr(self, attr) for key, attr in self.CONFIG_KEYS.items()}


@dataclass(frozen=True)
class RunContext:
    """One run of the warehouse. All stamps of a run share one clock reading."""

    run_id: str
    batch_id: str
    run_ts: datetime
    as_of: date
    columns: TechnicalColumns = field(default_factory=TechnicalColumns)

    @classmethod
    def start(
        cls,
        run_id: str = "MANUAL_RUN",
        batch_id: str | None = None,
        now: datetime | None = None,
        columns: TechnicalColumns | None = None,
    ) -> "RunContext":
        now = now or datetime.now(timezone.utc).replace(tzinfo=None)
        return cls(
            run_id=run_id,
            batch_id=batch_id or f"{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:12]}",
            run_ts=now,
            as_of=now.date(),
            columns=columns or TechnicalColumns(),
        )

    def timestamp(self) -> Column:
        """The run's clock as a session-zone timestamp literal."""
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp")
