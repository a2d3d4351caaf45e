"""Streaming queries over the driver's events, drained to the end, with the batch SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.staging import scratch
from ..streaming import events as W
from ..streaming import machines as S
from .registry import query


def _events(t):
    return S.files(t.spark, f"{t.sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


_MACHINE = """
WITH RECURSIVE v AS (SELECT user_id, epoch_us(ts) AS us, event_id FROM events WHERE event_type = 'view'), p AS (SELECT user_id, epoch_us(ts) AS us, event_id FROM events WHERE event_type = 'purchase'),
top AS (SELECT max(epoch_us(ts)) // 1000 * 1000 AS m FROM events),
s AS (SELECT user_id, o.us, o.event_id, (SELECT min((p.us, p.event_id)) FROM p WHERE p.user_id = o.user_id AND (p.us, p.event_id) > (o.us, o.event_id) AND p.us <= o.us + 43200000000) AS p FROM (SELECT user_id, min(us) AS us, arg_min(event_id, (us, event_id)) AS event_id FROM v GROUP BY 1) o
  UNION ALL SELECT user_id, o.us, o.event_id, (SELECT min((p.us, p.event_id)) FROM p WHERE p.user_id = o.user_id AND (p.us, p.event_id) > (o.us, o.event_id) AND p.us <= o.us + 43200000000)
  FROM (SELECT s.user_id, min(v.us) AS us, arg_min(v.event_id, (v.us, v.event_id)) AS event_id FROM s JOIN v ON v.user_id = s.user_id AND CASE WHEN s.p IS NULL THEN v.us > s.us + 43200000000 ELSE (v.us, v.event_id) > (s.p[1], s.p[2]) END GROUP BY s.user_id, s.us, s.event_id) o),
z AS (SELECT user_id, us, event_id, coalesce(p[1], us + 43200000000) AS z, coalesce(p[2], 9223372036854775807) AS zid, p IS NOT NULL AS bought FROM s)
SELECT user_id, event_id AS opened_id, z AS closed_us, CASE WHEN bought THEN 'purchase' ELSE 'timer' END AS closed_by,
  (SELECT count(*) FROM v WHERE v.user_id = z.user_id AND (v.us, v.event_id) > (z.us, z.event_id) AND (v.us, v.event_id) < (z.z, z.zid))::INT AS related
FROM z, top WHERE bought OR z.z < m OR EXISTS (SELECT 1 FROM events e WHERE e.user_id = z.user_id AND e.event_type IN ('view', 'purchase') AND epoch_us(e.ts) > z.z)
"""


@query(_MACHINE)
def stream_event_machine(t):
    e = _events(t).withWatermark("ts", "0 seconds").select(F.col("user_id").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    out = S.drained(S.event_machine(e, "view", "purchase", 12 * 3600 * 1_000_000), t.spark, "machine")
    return out.select(F.col("key").alias("user_id"), "opened_id", F.unix_micros("closed_at").alias("closed_us"), "closed_by", "related")


@query("""
WITH w AS (SELECT date_trunc('day', ts) AS d, event_type, value FROM events)
SELECT d AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL
""")
def stream_daily_counts(t):
    counted = S.window_counts(_events(t).withWatermark("ts", "1 hour"), "ts", "1 day", ["event_type"], "value")
    return S.drained(counted, t.spark, "daily").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(_MACHINE.replace("(SELECT count(*) FROM v WHERE v.user_id = z.user_id AND (v.us, v.event_id) > (z.us, z.event_id) AND (v.us, v.event_id) < (z.z, z.zid))::INT AS related", "coalesce((SELECT string_agg(v.event_id, ',' ORDER BY v.event_id) FROM v WHERE v.user_id = z.user_id AND (v.us, v.event_id) > (z.us, z.event_id) AND (v.us, v.event_id) < (z.z, z.zid)), '') AS attached"))
def stream_event_states(t):
    """The event machine by keyed state: timers close events, repeats are attached."""
    e = _events(t).withWatermark("ts", "0 seconds").select(F.col("user_id").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    out = W.run_to_end(W.event_states(e, "view", "purchase", 12 * 3600 * 1_000_000), t.spark, scratch(t.spark, "events"), scratch(t.spark, "events-marks"))
    return out.select(F.col("key").alias("user_id"), "opened_id", F.unix_micros("closed_at").alias("closed_us"), "closed_by", F.array_join(F.transform("attached", lambda x: x.cast("string")), ",").alias("attached"))
