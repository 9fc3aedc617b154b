"""Limiter: fixture rules, batch twin vs brute-force loop, stream twin vs batch."""

import os

import random

import pytest

from pyspark.sql import functions as F

from judicata.operators.windows import micros
from judicata.streaming.limiter import brute_force, limit_batch, limit_stream

S = 1_000_000


def test_limiter_fixture_rules(spark):
    # covers: STR-1
    base = 1_700_000_000 * S - (1_700_000_000 * S) % (86_400 * S)     # midnight
    rows = [(i, 1, base + i * S) for i in range(21)]                    # 21 in 21 s
    rows += [(100, 2, base), (101, 2, base + 60 * S)]                   # exactly 60 s apart
    out = brute_force(rows, 60, 20, 40)
    assert out[20] == (False, "ventana") and all(out[i][0] for i in range(20))
    # the hit 60 s old still counts: with max 1 the second is rejected
    out1 = brute_force([(100, 2, base), (101, 2, base + 60 * S)], 60, 1, 40)
    assert out1[101] == (False, "ventana")
    day = [(i, 3, base + i * 120 * S) for i in range(41)]
    outd = brute_force(day, 60, 20, 40)
    assert outd[40] == (False, "dia") and all(outd[i][0] for i in range(40))
    df = spark.createDataFrame(rows + day, "event_id long, user_id long, t long")
    got = {r.event_id: (r.aceptado, r.motivo) for r in limit_batch(df, window_s=60, max_hits=20, day_max=40).collect()}
    assert got == {**brute_force(rows, 60, 20, 40), **brute_force(day, 60, 20, 40)}


def test_limiter_batch_equals_loop_on_events(spark):
    # covers: STR-1
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "user_id", micros("ts").alias("t"))
    rows = [tuple(r) for r in e.collect()]
    want = brute_force(rows, 3600, 2, 4)
    got = {r.event_id: (r.aceptado, r.motivo) for r in limit_batch(e, window_s=3600, max_hits=2, day_max=4).collect()}
    assert got == want


@pytest.mark.parametrize("twin", ["applyInPandasWithState", "transformWithStateInPandas"])
def test_limiter_stream_equals_batch(spark, tmp_path, twin):
    # covers: STR-1
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "user_id", micros("ts").alias("t"), F.col("ts").cast("timestamp").alias("ts")).orderBy("t")
    src = tmp_path / "src"
    # land the events in three time-ordered files so the stream sees three micro-batches
    ts = [r.t for r in e.select("t").collect()]
    cut1, cut2 = ts[len(ts) // 3], ts[2 * len(ts) // 3]
    for i, cond in enumerate([F.col("t") < cut1, (F.col("t") >= cut1) & (F.col("t") < cut2), F.col("t") >= cut2]):
        e.where(cond).coalesce(1).write.parquet(str(src / f"part{i}"))
    stream = (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(str(src)))
    from judicata.streaming.limiter import limit_stream_tws
    fn = limit_stream if twin == "applyInPandasWithState" else limit_stream_tws
    out = fn(stream, window_s=3600, max_hits=2, day_max=4)
    qname = f"lim_out_{twin}"
    q = (out.writeStream.format("memory").queryName(qname).outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {r.event_id: (r.aceptado, r.motivo) for r in spark.table(qname).collect()}
    want = brute_force([(r.event_id, r.user_id, r.t) for r in e.collect()], 3600, 2, 4)
    assert got == want


def test_sliding_window_stream(spark, tmp_path):
    # covers: STR-2
    from judicata.streaming.trailing import sliding_counts
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    src = tmp_path / "ev"
    e.coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema(e.schema).parquet(str(src))
    out = sliding_counts(stream, width="1 hour", slide="30 minutes", watermark="1 hour")
    q = (out.writeStream.format("memory").queryName("slide_out").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("slide_out")
    # every event falls in exactly two 1-hour windows sliding by 30 minutes; windows
    # closed by the watermark are emitted, so the total is at most twice the events
    total = got.agg(F.sum("n")).first()[0] or 0
    assert 0 < total <= 2 * e.count()


def test_limiter_by_day_equals_loop(spark):
    # covers: STR-1 (day-parallel exact twin, including carries across midnight)
    from judicata.streaming.limiter import limit_batch_by_day
    day = 86_400 * S
    base = 20_000 * day
    rows = []
    eid = 0
    for d in range(4):                                   # a hot user with bursts around every midnight
        for s in list(range(-50, 0, 7)) + list(range(0, 50, 6)):
            rows.append((eid, 1, base + (d + 1) * day + s * S)); eid += 1
    for d in range(3):                                   # other users, spread out
        for u in range(2, 6):
            rows.append((eid, u, base + d * day + u * 3_600 * S)); eid += 1
    df = spark.createDataFrame(rows, "event_id long, user_id long, t long")
    for w, mh, dm in [(60, 3, 5), (60, 20, 40), (30, 2, 100)]:
        got = {r.event_id: (r.aceptado, r.motivo) for r in limit_batch_by_day(df, window_s=w, max_hits=mh, day_max=dm).collect()}
        assert got == brute_force(rows, w, mh, dm)
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", micros("ts").alias("t"))
    got = {r.event_id: (r.aceptado, r.motivo) for r in limit_batch_by_day(e, window_s=3600, max_hits=2, day_max=4).collect()}
    assert got == brute_force([tuple(r) for r in e.collect()], 3600, 2, 4)


@pytest.mark.parametrize("hot,pieces", [(10, 6), (10**6, 4)])
def test_limiter_splits_a_hot_day(spark, hot, pieces):
    # covers: STR-1
    from judicata.streaming.limiter import DAY_MICROS, limit_batch_by_day
    r = random.Random(3)
    rows = [(i, r.choice([1, 1, 1, 1, 2, 3]), int(r.choice([0, 0, 0, 1, 2]) * DAY_MICROS + r.uniform(0.3, 1.0) ** 2 * DAY_MICROS)) for i in range(1500)]
    rows += [(2000 + i, 4, 5 * DAY_MICROS - 30 * 10**6 + i * 10**6) for i in range(60)]              # around midnight
    rows += [(3000 + i, 5, 7 * DAY_MICROS) for i in range(50)]                                       # one moment
    df = spark.createDataFrame(rows, "event_id long, user_id long, t long").repartition(5)
    for w, mh, dm in [(3600, 2, 6), (10, 1, 1000)]:
        want = brute_force(rows, w, mh, dm)
        got = {x.event_id: (x.aceptado, x.motivo) for x in limit_batch_by_day(df, window_s=w, max_hits=mh, day_max=dm, hot_events=hot, pieces=pieces).collect()}
        assert got == want, (w, mh, dm)


def test_limiter_end_states_leave_in_batches(spark):
    # covers: STR-1; a batch of 2,000 short days made 2,000 batches of one row beside it
    import pyarrow as pa

    from judicata.streaming.limiter import REASONS, _run_groups

    class Held:
        """In place of the events: gives the function that Spark would run over them."""
        repartition = sortWithinPartitions = select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run      # noqa: E731

    day = 86_400 * S
    rows = [(u, d, i, (d * day) + k * 600 * S) for i, (u, d, k) in enumerate((u, d, k) for u in range(200) for d in range(10) for k in range(1 + (u + d) % 5))]
    none = pa.array([[]] * len(rows), pa.list_(pa.int64()))
    batch = pa.record_batch([*[pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1)], pa.array([0] * len(rows), pa.int32()),
                             *[pa.array([r[c] for r in rows], pa.int64()) for c in (2, 3)], pa.array([0] * len(rows), pa.int32()), none],
                            names=["user_id", "day", "chunk", "event_id", "t", "from_count", "from_hits"])
    run = _run_groups(Held(), 3600 * S, 2, 3)
    for cuts in ([0, len(rows)], [0, 1, 2, 700, 701, len(rows)]):      # a group may go on in the next batch
        out = list(run(batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])))
        assert len(out) <= 2 * len(cuts)
        out = [r for b in out for r in b.to_pylist()]
        got = {r["event_id"]: REASONS[r["motivo"]] for r in out if r["event_id"] is not None}
        assert got == {k: v[1] for k, v in brute_force([(r[2], r[0], r[3]) for r in rows], 3600, 2, 3).items()}
        ends = {(r["user_id"], r["day"]): r for r in out if r["event_id"] is None}
        assert len(ends) == 2000 and sum(r["count"] for r in ends.values()) == sum(v == "ok" for v in got.values())
