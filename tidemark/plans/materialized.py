"""Stored query results that are refreshed, and tables that follow their sources within a target lag."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import clock
from tidemark.functions.types import literal
from tidemark.operators.keys import as_condition, is_true, normalise_key
from tidemark.plans.load import Load, load
from tidemark.plans.publish import replace_table, set_properties, table_exists

log = logging.getLogger(__name__)

CONFIG = "tidemark.config"
REFRESHED = "tidemark.refreshed_at"
ON_CHANGE = ("apply", "continue", "fail")


def _fingerprint(config: Mapping[str, Any]) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()  # a handful of properties
    return next((r["value"] for r in rows if r["key"] == name), None)


@dataclass(frozen=True)
class MaterializedTable:
    """A query stored as a table, with the settings it was built from."""

    name: str
    build: Callable[[SparkSession], DataFrame]
    config: Mapping[str, Any] = field(default_factory=dict)
    location: str | None = None

    def refresh(
        self,
        spark: SparkSession,
        on_config_change: str = "apply",
        full_refresh: bool = False,
        now: dt.datetime | None = None,
    ) -> str:
        """Create, refresh or rebuild; returns what was done ('create', 'refresh', 'replace', 'skip')."""
        if on_config_change not in ON_CHANGE:
            raise ValueError(f"on_config_change must be one of {ON_CHANGE}, not {on_config_change!r}")
        wanted = _fingerprint(self.config)
        if not table_exists(spark, self.name):
            done = "create"
        elif full_refresh:
            done = "replace"
        elif _property(spark, self.name, CONFIG) == wanted:
            done = "refresh"
        elif on_config_change == "apply":
            done = "replace"
        elif on_config_change == "continue":
            log.warning("the settings of %s changed; it is left as it is", self.name)
            return "skip"
        else:
            raise ValueError(f"the settings of {self.name} changed and on_config_change is 'fail'")
        replace_table(
            self.build(spark),
            self.name,
            location=self.location,
            properties={CONFIG: wanted, REFRESHED: clock(now).isoformat()},
        )
        return done


@dataclass(frozen=True)
class FollowingTable:
    """A table kept within ``target_lag`` of its query.

    A full refresh gives what the query gives.  Rows meeting ``immutable_where`` are left as they are in the table: the
    query's rows that meet it are only taken when the table is created.

    An incremental refresh must be asked for.  It reads the query's rows from ``lookback`` below the table's high-water
    mark in ``watermark`` on, and merges them by the key of ``loading``: rows that arrive or change within that window
    are followed, older ones and deletions are not.  Call ``refresh_if_due`` from any timer, or use
    ``tidemark.streaming`` for a continuously running one.
    """

    name: str
    build: Callable[[SparkSession], DataFrame]
    target_lag: dt.timedelta
    refresh_mode: str = "auto"
    initialize: str = "on_create"
    watermark: str | None = None
    lookback: Any = None
    immutable_where: str | None = None
    loading: Load = field(default_factory=Load)
    location: str | None = None

    def __post_init__(self) -> None:
        if self.refresh_mode not in ("auto", "full", "incremental"):
            raise ValueError(f"unknown refresh mode {self.refresh_mode!r}")
        if self.initialize not in ("on_create", "on_schedule"):
            raise ValueError(f"unknown initialization {self.initialize!r}")
        if self.incremental and (self.watermark is None or not normalise_key(self.loading.unique_key)):
            raise ValueError("an incremental refresh needs a watermark column and a unique key to load by")
        if self.incremental and self.lookback is None:
            raise ValueError("an incremental refresh needs a look-back: how far below the mark rows may still arrive or change")

    @property
    def incremental(self) -> bool:
        return self.refresh_mode == "incremental"

    def create(self, spark: SparkSession, now: dt.datetime | None = None) -> None:
        """Create the table, filled at once or empty until the first scheduled refresh."""
        rows = self.build(spark)
        if self.initialize == "on_schedule":
            rows = rows.limit(0)
            now = dt.datetime(1, 1, 1)
        replace_table(
            rows,
            self.name,
            partition_by=self.loading.partition_by,
            location=self.location,
            properties={REFRESHED: clock(now).isoformat()},
        )

    def due(self, spark: SparkSession, now: dt.datetime) -> bool:
        last = _property(spark, self.name, REFRESHED)
        return last is None or now - dt.datetime.fromisoformat(last) >= self.target_lag

    def refresh_if_due(self, spark: SparkSession, now: dt.datetime | None = None) -> str:
        """Returns what was done: 'create', 'incremental', 'full' or 'skip'."""
        now = clock(now)
        if not table_exists(spark, self.name):
            self.create(spark, now)
            return "create"
        if not self.due(spark, now):
            return "skip"
        target = spark.table(self.name)
        rows = self.build(spark)
        if self.immutable_where is not None and not target.isEmpty():
            rows = rows.filter(~is_true(as_condition(self.immutable_where)))
        mark = target.agg(F.max(self.watermark)).first()[0] if self.incremental else None
        if mark is not None:
            recent = F.col(self.watermark) >= literal(mark - self.lookback, rows.schema[self.watermark].dataType)
            load(rows.filter(recent), self.name, replace(self.loading, full_refresh=False))
            set_properties(spark, self.name, **{REFRESHED: now.isoformat()})
            return "incremental"
        if self.immutable_where is not None:
            rows = target.filter(is_true(as_condition(self.immutable_where))).unionByName(rows)
        replace_table(rows, self.name, properties={REFRESHED: now.isoformat()})
        return "full"
