"""Analytical patterns (P21-P27): grouping sets, trend windows, lifecycle
states, per-group answers, rolling bests and streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.columns import DEFAULT_REFERRER_PATTERNS, host_pattern_class, pattern_class, safe_ratio
from cumulo.operators.ordered import ordinal_running, shifted


# Lifecycle labels (P23), keyed by (played now, played before).
STATE_LABELS = {"new": "New", "retired": "Retired", "continued": "Continued Playing",
                "returned": "Returned from Retirement", "stayed_retired": "Stayed Retired"}

# The three questions answered by `grouping_answers` (P24), in order.
QUESTIONS = ("who scored the most points playing for one team?",
             "who scored the most points in one season?",
             "which team has won the most games?")

# Dashboard labels.
ALL_DIMS_LABEL = "os_type__device_type__browser"
OVERALL = "(overall)"
UNKNOWN = "unknown"


def state_changes(facts: DataFrame, key: Sequence[str], period_col: str, out: str = "state") -> DataFrame:
    """New / Retired / Continued Playing / Returned from Retirement / Stayed Retired.

    Grid = each entity from its first period over the periods present in the
    data: `fill_gaps` generates the periods after each active one (no spine
    join, no theta join), then a semi join keeps the periods that occur.
    The lag window is per entity over its periods, bounded by the number of
    periods.
    """
    from cumulo.operators.cumulative import fill_gaps
    key = list(key)
    present = facts.select(*key, period_col).distinct()
    periods = present.select(period_col).distinct()  # one aggregate of the facts serves all three
    dense = fill_gaps(present, key, period_col, present.agg(F.max(period_col)).scalar())
    flags = dense.join(periods, on=period_col, how="left_semi").select(
        *key, period_col, F.when(F.col(period_col) == F.col("_src"), 1).otherwise(0).alias("played"))
    w = Window.partitionBy(*key).orderBy(period_col)
    prev = F.lag("played").over(w)
    L = STATE_LABELS
    label = (F.when((F.col("played") == 1) & prev.isNull(), L["new"])
             .when((F.col("played") == 0) & (prev == 1), L["retired"])
             .when((F.col("played") == 1) & (prev == 1), L["continued"])
             .when((F.col("played") == 1) & (prev == 0), L["returned"])
             .otherwise(L["stayed_retired"]))
    return flags.select(*key, period_col, label.alias(out))


def dashboard_rollup(df: DataFrame, dims: Sequence[str] = ("browser_type", "device_type", "os_type"),
                     label_col: str = "aggregation_level", count_col: str = "number_of_hits") -> DataFrame:
    """Hits by all dimensions and by each alone, in one scan (Expand)."""
    b, d, o = dims
    filled = df.select(*[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in dims])
    g = filled.groupingSets([[b, d, o], [b], [o], [d]], b, d, o).agg(
        F.count(F.lit(1)).alias(count_col),
        *[F.grouping(c).alias(f"_g_{c}") for c in dims])
    level = (F.when((F.col(f"_g_{o}") == 0) & (F.col(f"_g_{d}") == 0) & (F.col(f"_g_{b}") == 0),
                    ALL_DIMS_LABEL)
             .when(F.col(f"_g_{b}") == 0, b)
             .when(F.col(f"_g_{d}") == 0, d)
             .when(F.col(f"_g_{o}") == 0, o))
    return g.select(level.alias(label_col),
                    *[F.coalesce(F.col(c), F.lit(OVERALL)).alias(c) for c in (o, d, b)],
                    count_col)


def traffic_windows(events: DataFrame, *, patterns=DEFAULT_REFERRER_PATTERNS,
                    own_patterns: Sequence[str] = (), min_total: int = 500,
                    match_host: bool = False) -> DataFrame:
    """Daily hits per (url, referrer class) with trend windows.

    Windows are per (referrer, url) over days: one row per day after the
    aggregate, so partitions are bounded by the number of days. Previous
    week is rows 13..7 before (T6: the reference's 13..6 overlaps the
    current week). Frames count rows; days without hits are absent.
    With `match_host` a pattern must be whole labels of the referrer's host
    (T14: '%t.co%' as LIKE also matches e.g. 'https://www.microsoft.com').
    """
    pats = list(patterns) + [(p, "On Site") for p in own_patterns]
    if match_host:
        ref = host_pattern_class("referrer", pats)
    else:
        ref = pattern_class("referrer", pats)
    daily = (events.select("url", ref.alias("referrer"), F.to_date("event_time").alias("event_date"))
             .groupBy("url", "referrer", "event_date").agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy("referrer", "url").orderBy("event_date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    month = (Window.partitionBy("referrer", "url", F.trunc("event_date", "month")).orderBy("event_date")
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = daily.select(
        "referrer", "url", "event_date", "count",
        F.sum("count").over(w.rowsBetween(-6, 0)).alias("weekly_rolling_count"),
        F.sum("count").over(w.rowsBetween(-13, -7)).alias("previous_weekly_rolling_count"),
        F.sum("count").over(month).alias("_month_total"),
        F.sum("count").over(whole).alias("_total"))
    return (out.filter((F.col("_total") > min_total) & F.col("referrer").isNotNull())
            .select("referrer", "url", "event_date", "count", "weekly_rolling_count",
                    "previous_weekly_rolling_count",
                    safe_ratio("count", "_month_total").alias("pct_of_month"),
                    safe_ratio("count", "_total").alias("pct_of_total")))


def team_win(details: DataFrame, games: DataFrame) -> DataFrame:
    """Left join of box scores to games; a team wins when it is the
    home team of a home win or the visitor of a home loss."""
    g = games.select("game_id", "game_date", "season", "home_team_id", "home_team_wins")
    j = details.join(g, on="game_id", how="left")
    win = (F.when(F.col("home_team_id") == F.col("team_id"), F.col("home_team_wins"))
           .otherwise(F.when(F.col("home_team_wins") == 0, 1).otherwise(0)))
    return j.withColumn("team_win", win).drop("home_team_id", "home_team_wins")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first by `order` (which must make the
    choice total within a key).

    `row_number() ... = 1`: Spark plans it with a partial window group
    limit before the shuffle, so each map task forwards at most one row
    per key and a key with a huge share of duplicates never reaches one
    task whole (measured in SKEW.md).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def grouping_answers(details: DataFrame, games: DataFrame, *, player: str = "player_name",
                     team: str = "team_abbreviation", season: str = "season",
                     points: str = "pts", team_games: DataFrame | None = None) -> DataFrame:
    """Three questions from one grouping-sets scan.

    1 most points for one team (player, team); 2 most points in one season
    (player, season); 3 most wins (team). Team wins count once per game.
    The best row per set is a `max` over struct(metric, answer) - a partial
    aggregate, so no set is funnelled through a window; ties go to the
    greatest answer. Wins depend only on (game, team), so `team_games` may be
    the raw (not deduplicated) box scores: the win count then does not
    repeat the dedup.
    """
    d = team_win(details, games)
    d = d.withColumn(points, F.coalesce(F.col(points), F.lit(0.0)))
    pairs = (team_games if team_games is not None else details).select("game_id", "team_id").distinct()
    results = team_win(pairs, games).groupBy("game_id", "team_id").agg(F.max("team_win").alias("team_win"))
    wins = results.groupBy("team_id").agg(F.sum("team_win").cast("bigint").alias("total_wins"))
    data = d.join(wins, on="team_id", how="inner")
    g = data.groupingSets([[player, team], [player, season], [team]], player, team, season).agg(
        F.sum(points).alias("total_points"), F.max("total_wins").alias("total_wins"),
        F.grouping(player).alias("g_p"), F.grouping(team).alias("g_t"), F.grouping(season).alias("g_s"))
    q = (F.when((F.col("g_p") == 0) & (F.col("g_t") == 0), 1)
         .when((F.col("g_p") == 0) & (F.col("g_s") == 0), 2)
         .otherwise(3))
    metric = F.when(q == 3, F.col("total_wins").cast("double")).otherwise(F.col("total_points"))
    answer = F.when(q == 3, F.col(team)).otherwise(F.col(player))
    best = (g.select(q.alias("n"), F.struct(metric.alias("v"), answer.alias("a")).alias("s"))
            .groupBy("n").agg(F.max("s").alias("best")))
    question = (F.when(F.col("n") == 1, QUESTIONS[0]).when(F.col("n") == 2, QUESTIONS[1])
                .otherwise(QUESTIONS[2]))
    return best.select(question.alias("question"), F.col("best.a").alias("answer"),
                       F.col("best.v").alias("vals"))


def best_rolling(df: DataFrame, key: str, order: Sequence[str], measure: str, n: int = 90,
                 out: str = "max_in_window") -> DataFrame:
    """P25: per key, the largest sum of `measure` over any `n` consecutive rows;
    returns every key tied for the overall best (FETCH ... WITH TIES).

    Rolling sum = running(i) - running(i - n), with positions and running
    sums from `ordinal_running` (skew safe) and the i - n lookup as a 1:1 join.
    """
    r = ordinal_running(df.select(key, *order, measure), [key], order, {"_cum": F.col(measure)})
    s = shifted(r.select(key, "idx", "_cum"), [key], "idx", n, ["_cum"])
    roll = s.select(key, (F.col("_cum") - F.coalesce(F.col("prev__cum"), F.lit(0))).alias("_roll"))
    per_key = roll.groupBy(key).agg(F.max("_roll").alias(out))
    # ties for the best: semi join on the value with the one-row maximum
    # (an equi-join; both sides share the per-key aggregate's exchange)
    return per_key.join(per_key.agg(F.max(out).alias(out)), on=out, how="left_semi").select(key, out)


def longest_streak(df: DataFrame, key: str, order: Sequence[str], predicate,
                   out: str = "longest_streak") -> DataFrame:
    """Longest run of consecutive rows (per key, by `order`) where the
    predicate holds: islands by position minus running count of hits (E9)."""
    flag = F.when(predicate, 1).otherwise(0)
    r = ordinal_running(df.select(key, *order, flag.alias("_hit")), [key], order, {"_hits": F.col("_hit")})
    islands = r.filter(F.col("_hit") == 1).select(key, (F.col("idx") - F.col("_hits")).alias("_island"))
    runs = islands.groupBy(key, "_island").agg(F.count(F.lit(1)).alias("_len"))
    return runs.groupBy(key).agg(F.max("_len").cast("bigint").alias(out))
