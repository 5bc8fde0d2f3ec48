"""Stream jobs (L1-L8): batch forms of the transforms, and streams run to the end of the landed events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.operators.ordered import sessionize
from cumulo.plans import adapters as A
from cumulo.plans.registry import query
from cumulo.plans.sqlparts import WEB, with_
from cumulo.sources.scratch import scratch_path
from cumulo.streaming import runner
from cumulo.streaming import windows as SW

W20 = WEB.format(mod=20)
SESSIONS_SQL = with_(W20, """o AS (SELECT user_id, host, event_time,
  LAG(event_time) OVER (PARTITION BY user_id, host ORDER BY event_time) AS prev FROM web),
f AS (SELECT *, CASE WHEN prev IS NULL OR event_time - prev > INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS new FROM o),
s AS (SELECT *, SUM(new) OVER (PARTITION BY user_id, host ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
sess AS (SELECT user_id, host, MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 5 MINUTE AS session_end,
  COUNT(*) AS num_hits FROM s GROUP BY user_id, host, sid)""")


def _web(spark, sf):
    return A.web_events(spark, sf)


@query("tumbling_5m", with_(W20) + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, host,
  COUNT(*) AS num_hits FROM web GROUP BY 1, 2""")
def q_tumbling_5m(spark, sf):
    """L3: hits per 5-minute tumbling window and host."""
    return SW.tumbling_counts(_web(spark, sf), "event_time", ["host"])


@query("tumbling_5m_by_type", with_(W20) + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, host,
  referrer, COUNT(*) AS num_hits FROM web GROUP BY 1, 2, 3""")
def q_tumbling_5m_by_type(spark, sf):
    """L4: hits per 5-minute window, host and referrer."""
    return SW.tumbling_counts(_web(spark, sf), "event_time", ["host", "referrer"])


@query("sessions", SESSIONS_SQL + "SELECT * FROM sess")
def q_sessions(spark, sf):
    """L5 (batch): 5-minute-gap sessions per (user, host), skew-safe sessionizer.
    The stream form uses `session_window` (`streaming.windows.sessions`)."""
    return sessionize(_web(spark, sf), ["user_id", "host"], "event_time", 300)


@query("session_report", SESSIONS_SQL + """SELECT host, COUNT(*) AS num_sessions, CAST(SUM(num_hits) AS BIGINT) AS num_events,
  round(CAST(SUM(num_hits) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 2) AS avg_events_per_session FROM sess GROUP BY host""")
def q_session_report(spark, sf):
    """Sessions, events and mean events per session per host."""
    return SW.session_report(sessionize(_web(spark, sf), ["user_id", "host"], "event_time", 300))


_DOMAIN_SQL = SESSIONS_SQL.replace("o AS (SELECT user_id, host,", """named AS (SELECT * REPLACE (host || CASE user_id % 3 WHEN 0 THEN '.example.com'
  WHEN 1 THEN '.notexample.com' ELSE '.example.org' END AS host) FROM web),
o AS (SELECT user_id, host,""", 1).replace("AS prev FROM web)", "AS prev FROM named)")


@query("session_report_domain", _DOMAIN_SQL + """SELECT host, COUNT(*) AS num_sessions, CAST(SUM(num_hits) AS BIGINT) AS num_events,
  round(CAST(SUM(num_hits) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 2) AS avg_events_per_session FROM sess
WHERE host LIKE '%.example.com' GROUP BY host""")
def q_session_report_domain(spark, sf):
    """The session report of one domain's hosts and none of those whose names only end alike."""
    tail = F.when(F.col("user_id") % 3 == 0, ".example.com").when(F.col("user_id") % 3 == 1, ".notexample.com").otherwise(".example.org")
    named = _web(spark, sf).withColumn("host", F.concat("host", tail))
    return SW.session_report(sessionize(named, ["user_id", "host"], "event_time", 300), domain="example.com")


@query("landing_enrich", with_(WEB.format(mod=30)) + """SELECT event_id, date_trunc('millisecond', event_time) AS event_timestamp,
  CASE WHEN n_nationkey IS NULL THEN '{}' ELSE CAST(json_object('country', n_name,
    'state', 'REGION_' || CAST(n_regionkey AS VARCHAR), 'city', 'CITY_' || CAST(n_nationkey AS VARCHAR)) AS VARCHAR)
  END AS geodata
FROM web LEFT JOIN nation ON n_nationkey = web.device_id""")
def q_landing_enrich(spark, sf):
    """L1 (batch form): raw events with string times, as landed by the stream, parsed
    with the event-time pattern (H8) and enriched with location JSON (U1)."""
    from cumulo.plans.q_bi import locations
    raw = _web_raw(spark, sf)
    landed = SW.enrich_landing(raw, locations(spark, sf), key="device_id")
    return landed.select("event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                         "geodata")


def _web_raw(spark, sf):
    """Web events as the stream lands them: event time as an ISO string."""
    w = A.web_events(spark, sf, device_mod=30)
    return w.select("event_id", "device_id", "host", "url", "referrer",
                    F.date_format(F.col("event_time").cast("timestamp"), SW.EVENT_TIME_PATTERN).alias("event_time"))


# -- streams ----------------------------------------------------------------------------------------

STREAM_SCHEMA = "event_id long, device_id long, host string, url string, referrer string, event_time string, part int"
PARTS = 4  # the events land in four steps; the stream runs after each and goes on from its checkpoint


def _land_and_run(spark, sf, name: str, start):
    """The landed events, part by part (event id modulo `PARTS`), each followed by a run of the stream."""
    raw = _web_raw(spark, sf).withColumn("part", F.pmod("event_id", F.lit(PARTS)).cast("int"))
    landing, checkpoint = scratch_path(spark, f"{name}-landing"), scratch_path(spark, f"{name}-checkpoint")
    for part in range(PARTS):
        raw.where(F.col("part") == part).write.mode("append").parquet(landing)
        events = runner.events_with_time(runner.file_source(spark, landing, STREAM_SCHEMA, "parquet"))  # L2
        runner.start(events, f"{name}-{part}", batch_writer=start, checkpoint=checkpoint, available_now=True).awaitTermination()


def _summed(spark, path: str, keys: list, count: str):
    return spark.read.parquet(path).groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), *keys).agg(
        F.sum(count).alias(count))


def _two_sinks(spark, sf) -> dict[str, str]:
    paths = {n: scratch_path(spark, f"stream-{n}") for n in ("by_host", "by_referrer")}
    counts = lambda *by: lambda batch, _: SW.tumbling_counts(batch, "event_timestamp", list(by))
    _land_and_run(spark, sf, "tumbling", runner.sinks_writer(paths, {
        "by_host": counts("host"), "by_referrer": counts("host", "referrer")}))
    return paths


@query("stream_tumbling", with_(W20) + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, host,
  COUNT(*) AS num_hits FROM web GROUP BY 1, 2""")
def q_stream_tumbling(spark, sf):
    """Hits per 5-minute window and host out of a stream that feeds two sinks and is stopped and started
    again from its checkpoint after each part of the events."""
    return _summed(spark, _two_sinks(spark, sf)["by_host"], ["host"], "num_hits")


@query("stream_tumbling_by_referrer", with_(W20) + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, host,
  referrer, COUNT(*) AS num_hits FROM web GROUP BY 1, 2, 3""")
def q_stream_tumbling_by_referrer(spark, sf):
    """The second sink of the same stream: hits per window, host and referrer."""
    return _summed(spark, _two_sinks(spark, sf)["by_referrer"], ["host", "referrer"], "num_hits")


LATE_DELAY, LATE_WINDOW = 15, 300  # seconds


@query("stream_late_rows", with_(W20, f"""w AS (SELECT host, event_id % {PARTS} AS part,
  time_bucket(INTERVAL {LATE_WINDOW} SECOND, event_time) AS window_start, date_trunc('millisecond', event_time) AS t FROM web),
m AS (SELECT p.part, (SELECT MAX(t) FROM w x WHERE x.part < p.part) AS top FROM (SELECT DISTINCT part FROM w) p),
f AS (SELECT w.*, COALESCE(epoch(window_start) + {LATE_WINDOW} <= floor(epoch(top)) - {LATE_DELAY}, FALSE) AS late
      FROM w JOIN m USING (part))""") + """SELECT window_start, host, COUNT(*) FILTER (NOT late) AS num_hits,
  COUNT(*) FILTER (late) AS num_late FROM f GROUP BY 1, 2""")
def q_stream_late_rows(spark, sf):
    """Hits in time and rows too late for their window, per 5-minute window and host, out of a stream whose
    parts overlap in time; both add up to the events."""
    root = scratch_path(spark, "stream-late")
    _land_and_run(spark, sf, "late", runner.late_rows_writer(spark, root, "event_timestamp", LATE_DELAY, LATE_WINDOW, ["host"]))
    hits, late = (_summed(spark, f"{root}/{n}", ["host"], c) for n, c in (("counts", "num_hits"), ("late", "num_late")))
    both = hits.withColumn("num_late", F.lit(0).cast("long")).unionByName(late.withColumn("num_hits", F.lit(0).cast("long")))
    return both.groupBy("window_start", "host").agg(F.sum("num_hits").alias("num_hits"), F.sum("num_late").alias("num_late"))
