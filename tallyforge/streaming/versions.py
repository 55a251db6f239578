"""A change feed with memory: each version of a record is compared with the last one seen, whichever batch that came in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import comparable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE = "key string, ord string, field string, old_value string, new_value string"


class LastVersion(StatefulProcessor):
    """Keeps the fields of the last version of a record; with ``keep_ms`` it forgets a record that has not come for so long."""

    def __init__(self, fields: list[str], keep_ms: int | None):
        self.fields, self.keep_ms = fields, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", ", ".join(f"f{i} string" for i in range(len(self.fields))))
        if self.keep_ms:
            self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.keep_ms:
            now = timerValues.getCurrentProcessingTimeInMs()
            if self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
            self.timer.update((now + self.keep_ms,))
            self.handle.registerTimer(now + self.keep_ms)
        # the versions of one record in one batch, which are few
        table = pd.concat(list(rows)).sort_values(["ord", *[f"f{i}" for i in range(len(self.fields))]], kind="stable", na_position="first")
        before = self.last.get() if self.last.exists() else None
        out = []
        for r in table.itertuples(index=False):
            now_ = tuple(None if pd.isna(x) else x for x in (getattr(r, f"f{i}") for i in range(len(self.fields))))
            if before is not None and r.counts:
                out += [(key[0], r.shown, f, a, b) for f, a, b in zip(self.fields, before, now_) if a != b]
            before = now_
        self.last.update(before)
        yield pd.DataFrame(out, columns=["key", "ord", "field", "old_value", "new_value"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.last.clear()
        self.timer.clear()
        return iter(())

    def close(self) -> None:
        pass


def version_changes(records: DataFrame, key: str, order: str, fields: list[str], approved: Column | None = None, keep_ms: int | None = None) -> DataFrame:
    """A stream of (key, ord, field, old_value, new_value), one row for each field in which a version of a record differs
    from the version before it, by ``order`` within a batch and by batches.

    Values are compared as trimmed text, blank as null. A version that is not ``approved`` reports nothing and is what the
    next one is compared with all the same; the first version of a record reports nothing. State is one version per record,
    in the state store below the query's checkpoint, so that a restarted query goes on where it was; with ``keep_ms``
    (processing time) records that no longer come are forgotten. A null key is a record of its own. The session needs a state
    store that keeps several states: see ``use_state_store``.
    """
    one = records.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(order).alias("ord"), F.col(order).cast("string").alias("shown"),
        F.coalesce(approved if approved is not None else F.lit(True), F.lit(False)).alias("counts"), *[comparable(F.col(f)).alias(f"f{i}") for i, f in enumerate(fields)],
    )
    return one.groupBy("key").transformWithStateInPandas(LastVersion(fields, keep_ms), CHANGE, "append", "processingTime" if keep_ms else "none")


def use_state_store(spark: SparkSession) -> None:
    """The state store that ``version_changes`` needs, for the queries that the session starts from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
