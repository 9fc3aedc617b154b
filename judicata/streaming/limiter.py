"""Per-key request limiter (STR-1): sliding window plus daily cap.

Rule, per key and in event-time order:
  day = floor(t / 1 day); if the day's accepted count >= ``day_max`` -> reject ("dia");
  evict accepted hits older than ``window`` (strictly older; a hit exactly
  ``window`` old still counts); if ``max_hits`` remain -> reject ("ventana");
  otherwise accept and count it.  Rejected events use no quota.

The rule is a sequential state machine per key.  :func:`limit_batch_by_day` runs
days, and chunks of very busy days, in parallel from guessed states and mends the
wrong guesses; :func:`limit_batch` is its plain twin, a key in one task.  No twin
holds a key's events in memory: the batch twins stream each partition's sorted rows
batch by batch, the stream twins keep only O(max_hits) state per key in Spark's
fault-tolerant state store.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judicata.session import materialise

DAY_MICROS = 86_400 * 1_000_000

OUT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("t", T.LongType()),
    T.StructField("aceptado", T.BooleanType()),
    T.StructField("motivo", T.StringType()),
])


class _KeyState:
    __slots__ = ("day", "day_count", "hits", "last_t")

    def __init__(self, day=-1, day_count=0, hits=(), last_t=None):
        self.day, self.day_count, self.hits, self.last_t = day, day_count, deque(hits), last_t

    def step(self, t: int, window: int, max_hits: int, day_max: int) -> tuple[bool, str]:
        if self.last_t is not None and t < self.last_t:
            return False, "tarde"
        self.last_t = t
        day = t // DAY_MICROS
        if day != self.day:
            self.day, self.day_count = day, 0
        if self.day_count >= day_max:
            return False, "dia"
        while self.hits and t - self.hits[0] > window:
            self.hits.popleft()
        if len(self.hits) >= max_hits:
            return False, "ventana"
        self.hits.append(t)
        self.day_count += 1
        return True, "ok"


def limit_batch(events: DataFrame, key: str = "user_id", t: str = "t", tie: str = "event_id",
                window_s: int = 60, max_hits: int = 20, day_max: int = 40) -> DataFrame:
    """Batch twin: hash-partition by key, sort within partitions by (key, t, tie),
    then stream each partition through the state machine (constant memory per key)."""
    window = window_s * 1_000_000
    src = events.select(F.col(tie).cast("long").alias("event_id"), F.col(key).cast("long").alias("user_id"),
                        F.col(t).cast("long").alias("t"))
    src = src.repartition("user_id").sortWithinPartitions("user_id", "t", "event_id")

    def run(batches):
        cur_key, st = None, None
        for pdf in batches:
            acc, why = [], []
            for k, tt in zip(pdf["user_id"].to_numpy(), pdf["t"].to_numpy()):
                if k != cur_key:
                    cur_key, st = k, _KeyState()
                a, m = st.step(int(tt), window, max_hits, day_max)
                acc.append(a)
                why.append(m)
            yield pd.DataFrame({"event_id": pdf["event_id"], "user_id": pdf["user_id"], "t": pdf["t"],
                                "aceptado": acc, "motivo": why})

    return src.mapInPandas(run, OUT_SCHEMA)


STATE_SCHEMA = T.StructType([
    T.StructField("day", T.LongType()),
    T.StructField("day_count", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),
    T.StructField("last_t", T.LongType()),
])


def limit_stream(events: DataFrame, key: str = "user_id", ts: str = "ts", tie: str = "event_id",
                 window_s: int = 60, max_hits: int = 20, day_max: int = 40, watermark: str = "10 minutes") -> DataFrame:
    """Stream twin over a streaming DataFrame: ``applyInPandasWithState`` per key.

    Events inside a micro-batch are ordered by (t, tie); an event older than the
    key's last processed event is rejected explicitly as late ("tarde"); events
    behind the watermark never reach the operator.  State is bounded per key
    (at most ``max_hits`` timestamps) and is dropped by an event-time timeout
    once the watermark passes both the end of the key's current day and its last
    hit plus the window: from then on the key's state cannot affect any decision."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    from judicata.operators.windows import micros

    window = window_s * 1_000_000
    is_ltz = isinstance(events.schema[ts].dataType, T.TimestampType)
    t_col = F.unix_micros(F.col(ts)) if is_ltz else micros(F.col(ts))    # true epoch for zoned timestamps
    src = (events.withWatermark(ts, watermark)
                 .select(F.col(tie).cast("long").alias("event_id"), F.col(key).cast("long").alias("user_id"),
                         t_col.alias("t"), F.col(ts)))

    def fn(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            d, c, h, lt = state.get
            st = _KeyState(d, c, h or (), lt)
        else:
            st = _KeyState()
        parts = [p for p in pdfs]
        pdf = pd.concat(parts).sort_values(["t", "event_id"]) if parts else pd.DataFrame(columns=["event_id", "user_id", "t"])
        acc, why = [], []
        for tt in pdf["t"].to_numpy():
            a, m = st.step(int(tt), window, max_hits, day_max)
            acc.append(a)
            why.append(m)
        state.update((int(st.day), int(st.day_count), [int(x) for x in st.hits],
                      None if st.last_t is None else int(st.last_t)))
        if st.last_t is not None:
            until = max((st.day + 1) * DAY_MICROS, (st.hits[-1] if st.hits else st.last_t) + window)
            state.setTimeoutTimestamp(until // 1000)          # epoch milliseconds
        yield pd.DataFrame({"event_id": pdf["event_id"].astype("int64"), "user_id": pdf["user_id"].astype("int64"),
                            "t": pdf["t"].astype("int64"), "aceptado": acc, "motivo": why})

    return src.groupBy("user_id").applyInPandasWithState(
        fn, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


def brute_force(rows, window_s=60, max_hits=20, day_max=40):
    """Reference loop for tests: rows = iterable of (event_id, user_id, t)."""
    window = window_s * 1_000_000
    out, states = {}, {}
    for eid, uid, tt in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        st = states.setdefault(uid, _KeyState())
        out[eid] = st.step(tt, window, max_hits, day_max)
    return out


def _processor_class():
    """StatefulProcessor for ``transformWithStateInPandas`` (built lazily: the
    streaming API is imported only when used)."""
    from pyspark.sql.streaming import StatefulProcessor

    hits_schema = T.StructType([T.StructField("t", T.LongType())])
    meta_schema = T.StructType([T.StructField("day", T.LongType()), T.StructField("day_count", T.LongType()),
                                T.StructField("last_t", T.LongType()), T.StructField("timer_ms", T.LongType())])

    class LimiterProcessor(StatefulProcessor):
        """ListState: accepted hits inside the window; ValueState: (day, count, last event, timer).
        An event-time timer clears both once they can no longer affect a decision."""

        def __init__(self, window: int, max_hits: int, day_max: int):
            self.window, self.max_hits, self.day_max = window, max_hits, day_max

        def init(self, handle):
            self.handle = handle
            self.hits = handle.getListState("hits", hits_schema)
            self.meta = handle.getValueState("meta", meta_schema)

        def handleInputRows(self, key, rows, timerValues):
            m = self.meta.get() if self.meta.exists() else None
            hits = [h[0] for h in self.hits.get()] if self.hits.exists() else []
            st = _KeyState(m[0], m[1], hits, m[2]) if m else _KeyState()
            parts = list(rows)
            pdf = pd.concat(parts).sort_values(["t", "event_id"])
            acc, why = [], []
            for tt in pdf["t"].to_numpy():
                a, r = st.step(int(tt), self.window, self.max_hits, self.day_max)
                acc.append(a)
                why.append(r)
            if st.hits:
                self.hits.put([(int(h),) for h in st.hits])
            else:
                self.hits.clear()
            until = max((st.day + 1) * DAY_MICROS, (st.hits[-1] if st.hits else st.last_t) + self.window) // 1000
            if m and m[3] is not None and m[3] != until:
                self.handle.deleteTimer(int(m[3]))
            self.handle.registerTimer(int(until))
            self.meta.update((int(st.day), int(st.day_count), int(st.last_t), int(until)))
            yield pd.DataFrame({"event_id": pdf["event_id"].astype("int64"), "user_id": pdf["user_id"].astype("int64"),
                                "t": pdf["t"].astype("int64"), "aceptado": acc, "motivo": why})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.hits.clear()
            self.meta.clear()
            return iter([])

        def close(self):
            pass

    return LimiterProcessor


def limit_stream_tws(events: DataFrame, key: str = "user_id", ts: str = "ts", tie: str = "event_id",
                     window_s: int = 60, max_hits: int = 20, day_max: int = 40,
                     watermark: str = "10 minutes") -> DataFrame:
    """The limiter on ``transformWithStateInPandas`` (event time, RocksDB state
    store): the same rule and outputs as :func:`limit_stream`."""
    from judicata.operators.windows import micros

    is_ltz = isinstance(events.schema[ts].dataType, T.TimestampType)
    t_col = F.unix_micros(F.col(ts)) if is_ltz else micros(F.col(ts))
    src = (events.withWatermark(ts, watermark)
                 .select(F.col(tie).cast("long").alias("event_id"), F.col(key).cast("long").alias("user_id"),
                         t_col.alias("t"), F.col(ts)))
    proc = _processor_class()(window_s * 1_000_000, max_hits, day_max)
    return src.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=OUT_SCHEMA, outputMode="Append", timeMode="EventTime")


# ---------------------------------------------------------------- day-parallel batch twin

OK, WINDOW, DAY = range(3)
REASONS = ["ok", "ventana", "dia"]
GROUP = ["user_id", "day", "chunk"]
RUN_SCHEMA = ("user_id long, day long, chunk int, event_id long, t long, motivo int, count int, hits array<long>, "
              "from_count int, from_hits array<long>")
STATE = ["count", "hits", "from_count", "from_hits"]


def decide(t: list[int], lo: int, hi: int, why: list[int], count: int, hits: deque, window: int, max_hits: int, day_max: int) -> int:
    """Decisions of one group's next events ``t[lo:hi]`` in time order, into ``why``, which holds
    ``DAY``; ``hits`` is moved on, and the number accepted is returned.

    At most ``day_max`` events are accepted, and while the window is full all events up
    to its end are rejected at once, so the work is a few searches, not a step an event."""
    i = lo
    while i < hi and count < day_max:
        while hits and t[i] - hits[0] > window:
            hits.popleft()
        if len(hits) >= max_hits:
            j = bisect_right(t, hits[0] + window, i, hi) if hits else hi
            why[i:j] = [WINDOW] * (j - i)
            i = j
        else:
            why[i] = OK
            hits.append(t[i])
            count += 1
            i += 1
    return count


def _run_groups(ev: DataFrame, window: int, max_hits: int, day_max: int) -> DataFrame:
    """Run (key, day, chunk) groups in time order from their ``from_count`` and ``from_hits``:
    a row an event, and a row a group (event_id null) with its end state.

    Most groups are a few events, so the end states of a batch's groups leave in one batch."""
    x = ev.repartition(*[F.col(c) for c in GROUP]).sortWithinPartitions(*GROUP, "t", "event_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, count, hits, begin, ended = None, 0, deque(), (0, []), []

        def states() -> pa.RecordBatch:
            *group, counts, ends, from_count, from_hits = zip(*ended)
            none = pa.nulls(len(ended), pa.int64())
            return pa.record_batch([*[pa.array(v, k) for v, k in zip(group, (pa.int64(), pa.int64(), pa.int32()))], none, none,
                                    pa.nulls(len(ended), pa.int32()), pa.array(counts, pa.int32()), pa.array(ends, pa.list_(pa.int64())),
                                    pa.array(from_count, pa.int32()), pa.array(from_hits, pa.list_(pa.int64()))], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            key = [b.column(c).to_numpy() for c in GROUP]
            t = b.column("t").to_pylist()
            new = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]) | (key[2][1:] != key[2][:-1])) + 1
            edges = [0, *new.tolist(), b.num_rows]
            first = pa.array(edges[:-1], pa.int64())
            heads = zip(zip(*[k[edges[:-1]].tolist() for k in key]), b.column("from_count").take(first).to_pylist(),
                        b.column("from_hits").take(first).to_pylist())
            why = [DAY] * b.num_rows
            for lo, hi, (here, from_count, from_hits) in zip(edges, edges[1:], heads):
                if here != at:
                    if at is not None:
                        ended.append((*at, count, list(hits), *begin))
                    at, count, hits, begin = here, from_count, deque(from_hits), (from_count, from_hits)
                count = decide(t, lo, hi, why, count, hits, window, max_hits, day_max)
            none, lists = pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.list_(pa.int64()))
            yield pa.record_batch([*[b.column(c) for c in GROUP], b.column("event_id"), b.column("t"), pa.array(why, pa.int32()), none, lists, none, lists],
                                  names=names)
            if ended:
                yield states()
                ended.clear()
        if at is not None:
            ended.append((*at, count, list(hits), *begin))
            yield states()

    names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    return x.select(*GROUP, "event_id", "t", "from_count", "from_hits").mapInArrow(run, RUN_SCHEMA)


def _chunked(src: DataFrame, hot_events: int, pieces: int) -> tuple[DataFrame, DataFrame]:
    """(events with their chunk, days by key that are cut): a day of one key with more than
    ``hot_events`` events is cut at times that leave about equally many between them."""
    cuts = [i / pieces for i in range(1, pieces)]
    # counted first: a sketch of times for every day of every key costs more than the days that need one
    many = materialise(src.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("least"))
                       .where(F.col("n") > hot_events).select("user_id", "day", "least"))
    hot = materialise(src.join(many, ["user_id", "day"]).groupBy("user_id", "day")
                      .agg(F.min("least").alias("least"), F.percentile_approx("t", cuts, 100 * pieces).alias("cuts"))
                      .select("user_id", "day", F.filter(F.array_distinct("cuts"), lambda c: c > F.col("least")).alias("cuts")))
    chunk = F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c <= F.col("t"))))
    return src.join(hot, ["user_id", "day"], "left").select("event_id", "user_id", "day", "t", chunk.cast("int").alias("chunk")), hot


def limit_batch_by_day(events: DataFrame, key: str = "user_id", t: str = "t", tie: str = "event_id", window_s: int = 60, max_hits: int = 20,
                       day_max: int = 40, hot_events: int = 1_000_000, pieces: int = 64) -> DataFrame:
    """Exact limiter decisions with (key, day, chunk) groups processed in parallel.

    Only two things cross groups: over midnight the accepted hits inside the window
    (shorter than a day), and within a day also the number accepted so far.  A day of one key
    with more than ``hot_events`` events is cut into up to ``pieces`` chunks, so that a key
    or a key-day with a third of all events is spread over many tasks (events of one
    microsecond stay together).

    Every group first runs from nothing.  Then each is told where it truly starts: the
    hits its predecessor ended with, and how many the chunks before it accepted, a
    running sum over the day.  It is run again only if that changes a decision: if the
    hits differ, or the cap binds in one of the two runs.  The loop ends when no group is; a
    round fixes at least one more group of every chain, so the result equals the
    sequential rule, and rounds are few, as a chunk longer than the window ends alike
    whatever it starts from.  Each round's rows are written to the shared folder, and a
    group's decisions are those of its last run.  The rounds run while the plan is built."""
    if window_s >= 86_400:
        raise ValueError("the window must be shorter than a day")
    window = window_s * 1_000_000
    src = events.select(F.col(tie).cast("long").alias("event_id"), F.col(key).cast("long").alias("user_id"), F.col(t).cast("long").alias("t"))
    src, _ = _chunked(src.withColumn("day", F.floor(F.col("t") / F.lit(DAY_MICROS)).cast("long")), hot_events, pieces)

    nothing = F.array().cast("array<bigint>")
    runs = [materialise(_run_groups(src.withColumn("from_count", F.lit(0)).withColumn("from_hits", nothing), window, max_hits, day_max))]
    states = runs[0].where("event_id IS NULL").select(*GROUP, *STATE)
    known = None                                            # groups that ran again, and in which round
    chunks = Window.partitionBy("user_id", "day").orderBy("chunk")         # a row a chunk
    while True:
        taken = F.col("count") - F.col("from_count")
        x = states.withColumn("before", F.coalesce(F.sum(taken).over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        x = x.withColumn("prior", F.lag("hits").over(chunks))
        # of the last chunk that could accept anything, the hits inside the window at midnight
        eve = (x.where(F.col("before") < day_max).groupBy("user_id", "day").agg(F.max_by("hits", "chunk").alias("all"))
               .select("user_id", (F.col("day") + 1).alias("next_day"), ((F.col("day") + 1) * DAY_MICROS - window).alias("edge"), "all")
               .select("user_id", F.col("next_day").alias("day"), F.filter("all", lambda h: h >= F.col("edge")).alias("eve")))
        x = x.join(eve, ["user_id", "day"], "left")
        capped = F.col("before") >= day_max
        true_hits = F.when(capped, nothing).when(F.col("chunk") == 0, F.coalesce("eve", nothing)).otherwise(F.col("prior"))
        true_count = F.least("before", F.lit(day_max)).cast("int")
        x = x.withColumn("true_count", true_count).withColumn("true_hits", true_hits)
        free = (F.col("count") < day_max) & (F.col("true_count") + taken < day_max)         # the cap binds in neither run
        same = (F.col("from_hits") == F.col("true_hits")) & (free | (F.col("from_count") == F.col("true_count")))
        changed = materialise(x.where(~same).select(*GROUP, F.col("true_count").alias("from_count"), F.col("true_hits").alias("from_hits")))
        if changed.isEmpty():
            break
        runs.append(materialise(_run_groups(src.join(changed, GROUP), window, max_hits, day_max)))
        fresh = runs[-1].where("event_id IS NULL").select(*GROUP, *STATE)
        states = materialise(states.join(fresh.select(*GROUP), GROUP, "left_anti").unionByName(fresh))
        again = changed.select(*GROUP, F.lit(len(runs) - 1).alias("round"))
        known = materialise(again if known is None else known.join(again.select(*GROUP), GROUP, "left_anti").unionByName(again))
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.col("motivo") + 1)
    out = None
    for i, rows in enumerate(runs):
        rows = rows.where("event_id IS NOT NULL")
        if known is not None:
            last = known.select(*GROUP) if i == 0 else known.where(F.col("round") == i).select(*GROUP)
            rows = rows.join(last, GROUP, "left_anti" if i == 0 else "left_semi")
        rows = rows.select("event_id", "user_id", "t", (F.col("motivo") == OK).alias("aceptado"), reason.alias("motivo"))
        out = rows if out is None else out.unionByName(rows)
    return out
