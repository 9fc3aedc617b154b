"""Event-sequence family over ``events`` (user = magistrate / requester):
stage durations (WIN-13), tenure intervals (WIN-4/5), interval and as-of
assignment joins (JN-9/10), funnel (AGG-21), trailing rate (STR-2) and the
request limiter (STR-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.operators import match as MT
from judicata.operators import windows as WN
from judicata.operators.ranks import exact_quantiles
from judicata.plans import register
from judicata.session import materialise
from judicata.streaming.limiter import limit_batch_by_day
from judicata.tables import Tables

HOUR = 3_600 * 1_000_000
DAY = 24 * HOUR
# Funnel stages in order.
STAGES = ["view", "click", "signup", "purchase"]
# Limiter thresholds scaled to the sparse test stream (the service's defaults
# are 20 per 60 s and 40 per day); the rule itself is unchanged.
LIMIT_WINDOW_S, LIMIT_MAX, LIMIT_DAY = 3_600, 2, 6


def _events(spark, sf, *cols):
    e = Tables(spark, sf).events("event_id", "user_id", "event_type", "ts", *cols)
    return e.withColumn("t", WN.micros("ts"))


@register("stage_durations", sql="""
WITH e AS (SELECT event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events),
d AS (SELECT event_type, (epoch_us(nts) - epoch_us(ts)) // 1000000 AS dur_s FROM e WHERE nts IS NOT NULL)
SELECT event_type AS etapa, COUNT(*) AS n, avg(dur_s) AS mean,
       quantile_cont(dur_s, 0.5) AS median, quantile_cont(dur_s, 0.9) AS p90
FROM d GROUP BY event_type
""")
def stage_durations(spark, sf):
    """Time from each stage event to the user's next event, profiled per stage (WIN-13).

    The "next event" is computed inside (user, hour) buckets with a one-row-per-
    bucket carry, so a user with a third of all events is spread over many
    tasks; quantiles are read off by rank selection, no stage in one buffer."""
    e = _events(spark, sf)
    x = WN.next_in_sequence(e, "user_id", "t", "event_id", {"next_t": "t"}, bucket_micros=HOUR)
    d = materialise(x.where(F.col("next_t").isNotNull()).select(
        F.col("event_type").alias("etapa"), ((F.col("next_t") - F.col("t")) / 1_000_000).cast("long").alias("dur_s")))
    means = d.groupBy("etapa").agg(F.avg(F.col("dur_s").cast("double")).alias("mean"))
    return exact_quantiles(d, "etapa", "dur_s").join(means, "etapa").select("etapa", "n", "mean", "median", "p90")


def _signup_intervals(spark, sf):
    s = _events(spark, sf).where(F.col("event_type") == "signup")
    x = WN.next_in_sequence(s, "user_id", "t", "event_id", {"hasta_t": "t", "hasta": "ts"}, bucket_micros=DAY)
    return x.select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("desde"),
                    F.col("t").alias("desde_t"), "hasta", "hasta_t")


_INTERVALS_SQL = """
s AS (SELECT user_id, event_id AS signup_id, ts AS desde,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hasta
      FROM events WHERE event_type = 'signup')"""


@register("tenure_intervals", sql=f"""
WITH {_INTERVALS_SQL}
SELECT user_id, signup_id, desde, hasta, (epoch_us(hasta) - epoch_us(desde)) // 1000000 AS tenure_s,
       hasta IS NULL AS vigente
FROM s
""")
def tenure_intervals(spark, sf):
    """Sequential assignment intervals: each starts where the previous ends
    (``hasta`` = next start), tenure, and the current (open) one (WIN-4/5)."""
    x = _signup_intervals(spark, sf)
    return x.select("user_id", "signup_id", "desde", "hasta",
                    ((F.col("hasta_t") - F.col("desde_t")) / 1_000_000).cast("long").alias("tenure_s"),
                    F.col("hasta").isNull().alias("vigente"))


@register("interval_join", sql=f"""
WITH {_INTERVALS_SQL},
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, p.ts, s.signup_id
FROM p LEFT JOIN s ON p.user_id = s.user_id AND s.desde <= p.ts AND (s.hasta IS NULL OR p.ts < s.hasta)
""")
def interval_join(spark, sf):
    """Which assignment interval [desde, hasta) held each purchase (JN-9)."""
    iv = _signup_intervals(spark, sf)
    p = _events(spark, sf).where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "t")
    m = MT.interval_join(p, iv, "user_id", "t", "desde_t", "hasta_t", "signup_id",
                         {"signup_id": "signup_id"}, bucket=DAY)
    return m.select("event_id", "user_id", "ts", "signup_id")


@register("asof_assignment", sql="""
WITH s AS (SELECT user_id, event_id AS signup_id, ts AS desde FROM events WHERE event_type = 'signup'),
e AS (SELECT event_id, user_id, ts FROM events)
SELECT e.event_id, e.user_id, e.ts, s.signup_id, s.desde
FROM e ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.desde
""")
def asof_assignment(spark, sf):
    """Assignment in force at each event's time: latest signup at or before it (JN-10)."""
    e = _events(spark, sf).select("event_id", "user_id", "ts", "t")
    s = (_events(spark, sf).where(F.col("event_type") == "signup")
         .select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("desde"), "t"))
    m = MT.asof_join(e, s, "user_id", "t", "t", "signup_id", {"signup_id": "signup_id", "desde": "desde"}, bucket=DAY)
    return m.select("event_id", "user_id", "ts", "signup_id", "desde")


_STAGE_VALUES = ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(STAGES))


FUNNEL_MIN_VALUE = 150.0        # a stage counts with an event of at least this value


@register("funnel", sql=f"""
WITH st AS (SELECT * FROM (VALUES {_STAGE_VALUES}) v(orden, etapa)),
u AS (SELECT event_type AS etapa, COUNT(DISTINCT user_id) AS usuarios FROM events
      WHERE value >= {FUNNEL_MIN_VALUE} GROUP BY event_type)
SELECT st.orden, st.etapa, COALESCE(u.usuarios, 0) AS usuarios,
       COALESCE(u.usuarios, 0)::DOUBLE / NULLIF((SELECT usuarios FROM u WHERE etapa = '{STAGES[0]}'), 0)::DOUBLE AS conversion
FROM st LEFT JOIN u ON st.etapa = u.etapa
""")
def funnel(spark, sf):
    """Stage volumes (distinct users per stage) and conversion from the first stage (AGG-21)."""
    e = Tables(spark, sf).events("user_id", "event_type", "value")
    e = e.where(F.col("event_type").isin(*STAGES) & (F.col("value") >= FUNNEL_MIN_VALUE))
    u = e.groupBy(F.col("event_type").alias("etapa")).agg(F.count_distinct("user_id").alias("usuarios"))
    st = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i + 1).alias("orden"), F.lit(s).alias("etapa"))
                                                   for i, s in enumerate(STAGES)])))
    x = st.join(u, "etapa", "left").select("orden", "etapa", F.coalesce("usuarios", F.lit(0)).alias("usuarios"))
    first = x.where(F.col("orden") == 1).select(F.max("usuarios")).scalar()
    return x.withColumn("conversion", F.try_divide(F.col("usuarios").cast("double"), first.cast("double")))


@register("trailing_rate", sql=f"""
SELECT event_id, user_id, ts,
       COUNT(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {LIMIT_WINDOW_S} SECOND PRECEDING
                      AND CURRENT ROW) AS n_trailing,
       COUNT(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {LIMIT_WINDOW_S} SECOND PRECEDING
                      AND CURRENT ROW) > {LIMIT_MAX} AS excede
FROM events
""")
def trailing_rate(spark, sf):
    """Events of the same user in the trailing window, inclusive (STR-2): the
    plain-SQL upper bound of the limiter.  Halo buckets keep a hot user split."""
    e = _events(spark, sf).select("event_id", "user_id", "ts", "t")
    x = WN.trailing_count(e, "user_id", "t", LIMIT_WINDOW_S * 1_000_000, DAY)
    return x.select("event_id", "user_id", "ts", "n_trailing", (F.col("n_trailing") > LIMIT_MAX).alias("excede"))


# the rule event by event: state = day, accepted of the day, accepted times of the window
@register("limiter_batch", sql=f"""
WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, epoch_us(ts) // {DAY} AS day,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (
  SELECT k, event_id, user_id, t, day, 1 AS n, [t] AS hits, 'ok' AS motivo FROM e WHERE k = 1
  UNION ALL
  SELECT k, event_id, user_id, t, day, n + CAST(motivo = 'ok' AS INTEGER),
         CASE WHEN motivo = 'ok' THEN list_append(hits, t) ELSE hits END, motivo
  FROM (SELECT *, CASE WHEN n >= {LIMIT_DAY} THEN 'dia' WHEN len(hits) >= {LIMIT_MAX} THEN 'ventana' ELSE 'ok' END AS motivo
        FROM (SELECT e.k, e.event_id, e.user_id, e.t, e.day, CASE WHEN e.day = r.day THEN r.n ELSE 0 END AS n,
                     list_filter(r.hits, lambda x: e.t - x <= {LIMIT_WINDOW_S * 1_000_000}) AS hits
              FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)))
SELECT event_id, user_id, t, motivo = 'ok' AS aceptado, motivo FROM r
""")
def limiter_batch(spark, sf):
    """Accept/reject per request under the sliding-window + daily-cap rule (STR-1),
    exact, with (user, day) groups in parallel (a hot user is split by day)."""
    e = _events(spark, sf).select("event_id", "user_id", "t")
    return limit_batch_by_day(e, window_s=LIMIT_WINDOW_S, max_hits=LIMIT_MAX, day_max=LIMIT_DAY)


OPEN_FROM_HOURS = 100.0


@register("assignment_audit", sql=f"""
WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS desde_t,
                  CASE WHEN value >= {OPEN_FROM_HOURS} THEN NULL
                       ELSE epoch_us(ts) + CAST(floor(value * 3600000000.0) AS BIGINT) END AS hasta_t
           FROM events WHERE event_type = 'signup'),
n AS (SELECT *, lead(desde_t) OVER (PARTITION BY user_id ORDER BY desde_t, event_id) AS nxt FROM s)
SELECT user_id, COUNT(*) AS n_intervals, COUNT(*) FILTER (WHERE hasta_t IS NULL) AS n_open,
       COUNT(*) FILTER (WHERE nxt IS NOT NULL AND (hasta_t IS NULL OR hasta_t > nxt)) AS n_overlaps,
       COUNT(*) FILTER (WHERE nxt IS NOT NULL AND hasta_t < nxt) AS n_gaps,
       COUNT(*) FILTER (WHERE hasta_t IS NULL) > 1 AS inconsistente
FROM n GROUP BY user_id
""")
def assignment_audit(spark, sf):
    """Assignment intervals [start, start + duration) per person: overlaps with the
    next assignment, gaps, open intervals, and the consistency rule that at most
    one interval may be open (JN-11, WIN-5)."""
    s = _events(spark, sf, "value").where(F.col("event_type") == "signup")
    s = s.select("user_id", "event_id", F.col("t").alias("desde_t"),
                 F.when(F.col("value") >= OPEN_FROM_HOURS, F.lit(None).cast("long"))
                  .otherwise(F.col("t") + F.floor(F.col("value") * 3_600_000_000.0).cast("long")).alias("hasta_t"))
    a = MT.interval_audit(s, "user_id", "desde_t", "hasta_t", "event_id", bucket=DAY)
    return a.withColumn("inconsistente", F.col("n_open") > 1)
