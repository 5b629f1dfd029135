"""Limited gap filling of a streamed grid, with the last rows of each series held as keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chronoloom.functions.numeric import narrow as narrow_value
from chronoloom.operators.select import complete_rows
from chronoloom.schema import SYNC_KEYS, TEMPERATURE_FIELDS, TIME, duration_seconds
from chronoloom.session import find_package

# Keyed state with lists and timers is kept in RocksDB, on disk beside the executor and in the checkpoint.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every state partition reserves some MB of disk
}

_SENT = "sent"


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Start the streams inside with state in RocksDB; the session's own settings come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class LimitedFill(StatefulProcessor):
    """Forward, then backward fill by at most ``limit`` rows, a row given out once, for all groups of a share of them together.

    A row's fill depends on ``limit`` rows before it and ``limit`` after it. The state of a group is therefore its last
    ``2 * limit`` rows at most, as they came, each with a mark whether it was given out. A row is final once all its fields are filled
    or ``limit`` later rows are there. With ``patience`` a group whose newest row the watermark has passed by so much is
    taken to have ended, its waiting rows are final as they are, and its state goes; a share's timer runs to the first such end.
    """

    def __init__(
        self, group: Sequence[str], order: Sequence[str], fields: Sequence[str], limit: int, schema: T.StructType, patience: int | None
    ) -> None:
        self.columns, self.group, self.order, self.fields = schema.fieldNames(), list(group), list(order), list(fields)
        self.limit, self.schema, self.patience = limit, schema, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", T.StructType([*self.schema.fields, T.StructField(_SENT, T.BooleanType())]))

    def _held(self) -> pd.DataFrame:
        rows = pd.DataFrame(list(self.held.get()), columns=[*self.columns, _SENT])
        return rows.astype({field: "float64" for field in self.fields})

    def _hold(self, rows: pd.DataFrame) -> None:
        plain = rows.astype(object).where(rows.notna(), None)
        self.held.put(list(plain.itertuples(index=False, name=None)))

    def _numbers(self, rows: pd.DataFrame) -> np.ndarray:
        return rows.groupby(self.group, dropna=False, sort=False).ngroup().to_numpy()

    def _filled(self, rows: pd.DataFrame, numbers: np.ndarray) -> pd.DataFrame:
        values = rows[self.fields].astype("float64")
        if not self.limit:
            return values
        return values.groupby(numbers).ffill(limit=self.limit).groupby(numbers).bfill(limit=self.limit)

    def _out(self, rows: pd.DataFrame, filled: pd.DataFrame, chosen) -> pd.DataFrame:
        return pd.concat([rows.drop(columns=[*self.fields, _SENT]), filled], axis=1)[chosen][self.columns]

    def _ends(self, rows: pd.DataFrame, numbers: np.ndarray) -> pd.Series:
        """For each row the watermark, in milliseconds, at which its group has ended."""
        return (rows[self.order[0]].groupby(numbers).transform("max") + self.patience).astype("int64") * 1000

    def _set_timer(self, ends: pd.Series, timerValues) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(ends):
            self.handle.registerTimer(max(int(ends.min()), timerValues.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)[self.columns]
        held = self._held()
        new = arrived.sort_values(self.order, kind="stable").assign(**{_SENT: False})
        frame = pd.concat([held, new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        numbers = self._numbers(frame)
        filled = self._filled(frame, numbers)
        after = frame.groupby(numbers).cumcount(ascending=False)  # as many rows of the group come after it
        final = ~frame[_SENT].astype(bool) & (filled.notna().all(axis=1) | (after >= self.limit))
        kept = after < max(2 * self.limit, 1)
        if self.patience is not None:
            ends = self._ends(frame, numbers)
            silent = ~(pd.Series(frame.index >= len(held)).groupby(numbers).transform("any"))
            over = silent & (ends <= timerValues.getCurrentWatermarkInMs())  # rows of other groups have come in the timer's stead
            final, kept = final | (over & ~frame[_SENT].astype(bool)), kept & ~over
            self._set_timer(ends[kept], timerValues)
        frame[_SENT] = frame[_SENT].astype(bool) | final
        self._hold(frame[kept])
        yield self._out(frame, filled, final)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        frame = self._held()
        if not len(frame):
            return
        numbers = self._numbers(frame)
        ends = self._ends(frame, numbers)
        over = ends <= max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        if over.all():
            self.held.clear()
        else:
            self._hold(frame[~over])
        self._set_timer(ends[~over], timerValues)
        yield self._out(frame, self._filled(frame, numbers), over & ~frame[_SENT].astype(bool))

    def close(self) -> None:
        pass


def stream_filled(
    grid: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = SYNC_KEYS,
    fill_limit: int = 2,
    fill_scope: str = "system",
    narrow: str | None = None,
    temperatures: Sequence[str] = TEMPERATURE_FIELDS,
    patience: str | None = None,
    incomplete: bool = False,
    shares: int = 512,
) -> DataFrame:
    """Short gaps of a streamed grid filled as they close: the stream of the rows of ``complete_grid``, each of them once.

    ``grid`` gives its rows in time order from batch to batch, as ``stream_grid`` does. The result equals the batch fill of all grid rows seen
    so far, whatever the batches are. ``incomplete`` also passes on rows that stay incomplete, once they are final. ``patience`` needs
    a watermark on the grid and ends a series that has been silent for so long. State is ``2 * fill_limit`` rows for each
    system (``fill_scope="system"``) or series. Systems or series are dealt by hash into ``shares``, each of which is one key of the state and
    filled in one go, as a call for every series costs more than its rows; the number stays the same for the life of a checkpoint.
    Start the stream within ``disk_state``.
    """
    if fill_scope not in ("system", "series"):
        raise ValueError(f"unknown fill scope {fill_scope!r}")
    group = list(keys[:1]) if fill_scope == "system" else list(keys)
    order = [TIME, *keys[1:]] if fill_scope == "system" else [TIME]
    columns = [TIME, *keys, *fields]
    plain = {c: f"c{i}" for i, c in enumerate(columns)}  # workers get rows as named tuples, which rename a leading underscore
    rows = grid.select(*[F.col(c).alias(name) for c, name in plain.items()])
    dealt = rows.withColumn("share", F.pmod(F.xxhash64(*[plain[c] for c in group]), F.lit(shares)))
    seconds = duration_seconds(patience) if patience is not None else None
    find_package(grid.sparkSession)  # the state's class is loaded in the workers
    processor = LimitedFill([plain[c] for c in group], [plain[c] for c in order], [plain[c] for c in fields], fill_limit, rows.schema, seconds)
    mode = "None" if seconds is None else "EventTime"
    filled = dealt.groupBy("share").transformWithStateInPandas(processor, rows.schema, "Append", mode).toDF(*columns)
    narrowed = [narrow_value(F.col(f), narrow, f in temperatures).alias(f) for f in fields]
    return (filled if incomplete else complete_rows(filled, list(fields))).select(TIME, *keys, *narrowed)
