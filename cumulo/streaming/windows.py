"""Event-time transforms shared by batch and streaming DataFrames.

Each function takes a DataFrame (static or streaming) and returns one; the
runner decides sources, sinks, output modes and checkpoints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.columns import domain_match, safe_ratio, ts_parse

EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def parse_event_time(df: DataFrame, raw: str = "event_time", out: str = "event_timestamp",
                     pattern: str = EVENT_TIME_PATTERN) -> DataFrame:
    """L1/L2/H8: parse the event-time string; malformed values become NULL.

    The result is TIMESTAMP (session time zone UTC), which a watermark needs;
    `timestamp_ntz` columns are rejected by `withWatermark`.
    """
    return df.withColumn(out, ts_parse(raw, pattern).cast("timestamp"))


def with_watermark(df: DataFrame, ts: str = "event_timestamp", delay: str = "15 seconds") -> DataFrame:
    """L2: rows later than max(event time) - delay are dropped by stateful operators."""
    return df.withWatermark(ts, delay)


def tumbling_counts(df: DataFrame, ts: str, by: Sequence[str], size: str = "5 minutes",
                    start_col: str = "window_start", count_col: str = "num_hits") -> DataFrame:
    """L3/L4: hits per tumbling window and key (T18: the start column is named for what it is)."""
    g = df.groupBy(F.window(F.col(ts), size).alias("_w"), *by).agg(F.count(F.lit(1)).alias(count_col))
    return g.select(F.col("_w.start").alias(start_col), *by, count_col)


def sessions(df: DataFrame, ts: str, by: Sequence[str], gap: str = "5 minutes",
             count_col: str = "num_hits") -> DataFrame:
    """Session windows per key: events at most `gap` apart share a session
    (T21: exactly one gap apart still merges); the session ends `gap` after
    its last event. This is the streaming form (state per key in the state
    store, local merging enabled in `cumulo.session`); batch jobs over
    skewed keys use `operators.ordered.sessionize`."""
    g = df.groupBy(F.session_window(F.col(ts), gap).alias("_s"), *by).agg(F.count(F.lit(1)).alias(count_col))
    return g.select(*by, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), count_col)


def session_report(sess: DataFrame, host: str = "host", domain: str | None = None,
                   count_col: str = "num_hits", digits: int = 2) -> DataFrame:
    """Mean events per session (D9: rounded), sessions and events per host; with
    `domain` only that domain and its subdomains."""
    s = sess.filter(domain_match(host, domain)) if domain else sess
    return s.groupBy(host).agg(
        F.count(F.lit(1)).alias("num_sessions"), F.sum(count_col).cast("bigint").alias("num_events"),
        F.round(safe_ratio(F.sum(count_col), F.count(F.lit(1))), digits).alias("avg_events_per_session"))


def enrich_landing(df: DataFrame, locations: DataFrame | None = None, key: str = "ip") -> DataFrame:
    """L1: pass-through enrichment before landing (parsed time, optional geo JSON)."""
    out = parse_event_time(df)
    if locations is not None:
        from cumulo.operators.lookup import geo_enrich
        out = geo_enrich(out, locations, key)
    return out
