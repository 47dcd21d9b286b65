"""A session's account on a stream: steps, cost, failures, and the action that ends it.

``session_window`` closes a session by a gap in time; an episode ends by what
happens in it: with its first ``finish``, or at its step limit.  ``ledger`` keeps
four counters per session as keyed state (``transformWithState``; the key is a
bucket of sessions, so a call to the state serves many of them) and gives every
action the columns that ``actionlog.annotate`` computes from a whole table, plus
``ended_by`` on the one action that ends its session.

Actions count in event order (time, then the other order columns).  A session's
actions wait in its bucket's state until the watermark has passed them, so those that
arrive out of order within ``delay`` are put in order; later ones are dropped, as
Spark's watermark does.  Waiting actions are bounded by ``delay``, the counters by
the number of sessions; with ``forget`` a session that was idle for so long starts
anew, and its counters go when the watermark has passed that time.  The state of one session lives in one task, as all keyed
streaming state does.  A bucket's counters are read and written together: streams of many millions of sessions take more ``buckets``.

Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``);
:func:`replay` sets it for its own run.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kintsugi.operators.actionlog import action_cost, is_invalid
from kintsugi.session import checkpoint_dir, materialize

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State travels as packs of Python values: a call for each value would cost more than what is counted.
_PACKED = "packed binary"
#: Actions in one pack.
_PACK = 5000
#: Sessions are dealt over so many buckets; each has one entry in the state.
BUCKETS = 4096
_BUCKET = "__bucket"
#: The event time in microseconds, which no time zone of a worker touches.
_AT = "__at"
_ADDED = T.StructType([T.StructField("step", T.LongType()), T.StructField("cum_cost", T.DoubleType()),
                       T.StructField("cum_invalid", T.LongType()), T.StructField("active", T.BooleanType()),
                       T.StructField("ended_by", T.StringType())])


class _Accounts(StatefulProcessor):
    """Orders the actions of a bucket of sessions behind the watermark and counts them by session."""

    def __init__(self, rows: T.StructType, session: str, order_by: list[str], max_steps: int, forget_ms: int | None):
        self.max_steps, self.forget_ms = max_steps, forget_ms
        self.session, self.at = rows.names.index(session), rows.names.index(_AT)
        self.order = [self.at, *(rows.names.index(c) for c in order_by[1:])]
        self.cost, self.invalid, self.kind = (rows.names.index(c) for c in ("cost", "invalid", "action_type"))
        self.out = Row(*rows.names, *_ADDED.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counters = handle.getValueState("counters", _PACKED)
        self.waiting = handle.getListState("waiting", _PACKED)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = None
        while come := [tuple(row) for row in islice(rows, _PACK)]:
            self.waiting.appendList([(pickle.dumps(come),)])
            least = min(row[self.at] for row in come)
            first = least if first is None else min(first, least)
        if first is not None:
            self._wake(_ms(first), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = [row for pack in self.waiting.get() for row in pickle.loads(pack[0])]
        due = [row for row in held if _ms(row[self.at]) <= now]
        rest = [row for row in held if _ms(row[self.at]) > now]
        if due and rest:
            self.waiting.put([(pickle.dumps(rest[i:i + _PACK]),) for i in range(0, len(rest), _PACK)])
        elif due:
            self.waiting.clear()
        packed = self.counters.get()
        counters = pickle.loads(packed[0]) if packed else {}
        yield from self._count(due, counters)
        wanted = [_ms(min(row[self.at] for row in rest))] if rest else []
        if self.forget_ms is not None:
            idle = [k for k, c in counters.items() if c[4] + self.forget_ms <= now]
            for k in idle:
                del counters[k]
            wanted += [min(c[4] for c in counters.values()) + self.forget_ms] if counters else []
        if counters:
            self.counters.update((pickle.dumps(counters),))
        elif packed:
            self.counters.clear()
        if wanted:
            self._wake(min(wanted), now)

    def _wake(self, ms: int, now: int) -> None:
        """One timer to come per bucket: the earliest one wanted.  Those up to ``now`` are about to expire or just do."""
        timers = [t for t in self.handle.listTimers() if t > now]
        if not timers or min(timers) > ms:
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(ms)

    def _count(self, due: list[tuple], counters: dict) -> Iterator[Row]:
        new = (0, 0.0, 0, False, None)
        due.sort(key=lambda row: [(row[i] is not None, row[i]) for i in self.order])
        for row in due:
            name = _name(row[self.session])
            step, cost, invalid, ended, last = counters.get(name, new)
            at = _ms(row[self.at])
            if self.forget_ms is not None and last is not None and at - last >= self.forget_ms:
                step, cost, invalid, ended, _ = new
            step, cost, invalid = step + 1, cost + row[self.cost], invalid + row[self.invalid]
            active = not ended and step <= self.max_steps
            why = None if not active else "finish" if row[self.kind] == "finish" else "max_steps" if step == self.max_steps else None
            counters[name] = (step, cost, invalid, ended or why is not None, at)
            yield self.out(*row, step, cost, invalid, active, why)


def _name(session):
    """A session's key in a dictionary: equal where Spark groups them together."""
    try:
        hash(session)
    except TypeError:
        return repr(session)
    return session if session == session else "NaN"


def _ms(micros: int) -> int:
    """The first millisecond at which the watermark has passed a time."""
    return -(-micros // 1000)


def ledger(log: DataFrame, session: str = "session_id", order_by: list[str] = ("ts", "event_id"), delay: str = "1 hour",
           max_steps: int = 20, forget: timedelta | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The streaming ``log`` with cost, invalid, step, cum_cost, cum_invalid, active and ended_by for each action.

    The first order column is the event time; actions without one are dropped (they have no place in the order)."""
    ts = order_by[0]
    a = log.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull()) \
        .withColumn("cost", action_cost(F.col("action_type"))) \
        .withColumn("invalid", is_invalid(F.col("action_type"), F.col("valid")).cast("long")) \
        .withColumn(_AT, F.unix_micros(ts)) \
        .withColumn(_BUCKET, F.pmod(F.xxhash64(session), F.lit(buckets)).cast("int"))
    rows = T.StructType([T.StructField(f.name, f.dataType, True) for f in a.schema])
    out = T.StructType([*rows.fields, *_ADDED.fields])
    forget_ms = None if forget is None else int(forget.total_seconds() * 1000)
    return a.withWatermark(ts, delay).groupBy(_BUCKET).transformWithState(
        _Accounts(rows, session, list(order_by), max_steps, forget_ms), out, outputMode="Append", timeMode="EventTime").drop(_AT, _BUCKET)


def session_ends(accounts: DataFrame, session: str = "session_id") -> DataFrame:
    """(session, end_step, ended_by, cost_used, invalid_actions) as soon as a session ends, from a ledger's rows."""
    return accounts.where(F.col("ended_by").isNotNull()).select(
        session, F.col("step").alias("end_step"), "ended_by", F.col("cum_cost").alias("cost_used"),
        F.col("cum_invalid").alias("invalid_actions"))


def replay(log: DataFrame, session: str = "session_id", order_by: list[str] = ("ts", "event_id"), delay: str = "1 hour",
           max_steps: int = 20, files_per_batch: int | None = None) -> DataFrame:
    """A whole log through the stream: stored in the shared folder, read as a file stream with everything available,
    and closed by one row far in the future that lets the watermark pass all others.

    With ``files_per_batch`` the rows come in several micro-batches, by file; the log's files must then be in time
    order up to ``delay``."""
    spark = log.sparkSession
    base = f"{checkpoint_dir(spark)}/replay-{uuid.uuid4().hex}"
    log.write.parquet(f"{base}/log")
    kinds = {f.name: f.dataType for f in log.schema}
    end = datetime(9999, 1, 1)
    close = spark.range(1).select(*[F.lit(end).cast(kinds[c]).alias(c) if c == order_by[0] else F.lit(None).cast(kinds[c]).alias(c)
                                    for c in log.columns])
    close.write.mode("append").parquet(f"{base}/log")
    reader = spark.readStream.schema(log.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        accounts = ledger(reader.parquet(f"{base}/log"), session, order_by, delay, max_steps)
        query = (accounts.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
                 .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
    done = spark.read.schema(accounts.schema).parquet(f"{base}/out").where(F.col(order_by[0]) < F.lit(end).cast("timestamp"))
    return materialize(done.withColumn(order_by[0], F.col(order_by[0]).cast(kinds[order_by[0]])))
