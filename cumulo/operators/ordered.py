"""Order-dependent computations that stay distributed inside one large group.

A plain window partitioned by a low-cardinality key (a team, a player, a
user) runs each group in one task; one key holding a third of the rows
would serialise a third of the job. These helpers cut each key's rows into
slices along the order, so a large group spans many slices, compute local
running values per slice and add per-slice offsets from a small table of
slice totals (one row per slice and key). NULL keys are a key like any other.

Slices are balanced (`balanced_slices`): a first cut takes a fixed width of the
first order column; groups that still hold more than `limit` rows are cut
again at places taken from an exact histogram of their values, and again,
over as many order columns as it takes. The places are stored, so a
row's slice depends on the row and the stored tables alone, and a lost
executor changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from cumulo.sources.scratch import stored

# Width of a slice of the first cut: days of a date, seconds of a timestamp, units of a number.
WIDTHS = {"date": 30, "timestamp": 6 * 3600, "number": 100_000}
LIMIT = 1_000_000  # rows of a slice
SHARE = 100_000  # at most so many groups are cut again: a slice may hold 1 / SHARE of all rows whatever the limit
CELLS = 4096  # cells of a histogram
LEVELS = 12


def _slice(df: DataFrame, col: str, width: int | None) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, DateType):
        return F.floor(F.unix_date(F.col(col)) / (width or WIDTHS["date"]))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.floor(F.unix_timestamp(F.col(col).cast("timestamp")) / (width or WIDTHS["timestamp"]))
    return F.floor(F.col(col) / (width or WIDTHS["number"]))


def _place(df: DataFrame, col: str) -> Column | None:
    """The column on the number line (never decreasing with it), None for a type that has no such place."""
    kind = df.schema[col].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(F.col(col)).cast("double")
    return F.col(col).cast("double") if isinstance(kind, (NumericType, BooleanType)) else None


def balanced_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: int | None = None,
                    limit: int | None = None) -> DataFrame:
    """`df` with `_slice`: a struct that grows with the order inside a key; no slice has more than about `limit` rows
    unless they agree in all order columns that are numbers, dates or timestamps.

    Per level one pass counts the rows of each slice; those above the limit get cut places: the first of
    their order columns that is not constant is laid out in `CELLS` cells, and a new slice begins where the
    running count passes the limit (NULL comes first and is a place of its own). The tables of cut places have one
    row for each slice above the limit, fewer than the greater of rows / limit and `SHARE`, and are
    broadcast."""
    keys, order = list(keys), list(order)
    limit = limit or LIMIT
    path = [_slice(df, order[0], width).alias("_s0")]
    out, names = df.select("*", *path), ["_s0"]
    places = {c: p for c in order if (p := _place(df, c)) is not None}
    usable = order[:next((i for i, c in enumerate(order) if c not in places), len(order))]
    done = None  # slices that cannot be cut further
    for level in range(1, LEVELS):
        group = F.struct(*[F.col(n) for n in names], *keys)
        rows = out.select(group.alias("_g"), *[places[c].alias(f"_v{i}") for i, c in enumerate(usable)],
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(usable)])
        full = rows.groupBy("_g").agg(
            F.count(F.lit(1)).alias("_n"), *[f(f"_v{i}").alias(f"_{f.__name__}{i}") for i in range(len(usable)) for f in (F.min, F.max)],
            *[(F.count_if(F.col(f"_o{i}").isNull()).between(1, F.count(F.lit(1)) - 1)
               | ~F.min(f"_o{i}").eqNullSafe(F.max(f"_o{i}"))).alias(f"_varies{i}") for i in range(len(usable))])
        total = F.greatest(F.lit(limit), F.floor(out.agg(F.count(F.lit(1))).scalar() / SHARE))
        pick = F.coalesce(*[F.when(F.col(f"_varies{i}"), F.lit(i)) for i in range(len(usable))])
        at = lambda f: F.element_at(F.array(*[F.col(f"_{f}{i}") for i in range(len(usable))]), F.col("_col") + 1)
        full = full.withColumn("_limit", total).where(F.col("_n") > F.col("_limit")).withColumn("_col", pick).where("_col IS NOT NULL")
        full = full.select("_g", "_limit", "_col", at("min").alias("_lo"), at("max").alias("_hi"))
        if done is not None:
            full = full.join(done, "_g", "left_anti")
        full = stored(full, "full-slices")
        if not full.head(1):
            break
        value = F.element_at(F.array(*[F.col(f"_v{i}") for i in range(len(usable))]), F.col("_col") + 1)
        cell = F.when(value.isNull(), -1).when(F.col("_hi") > F.col("_lo"), F.floor(
            (value - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (CELLS - 1))).otherwise(0).cast("long")
        cells = rows.join(F.broadcast(full), "_g").groupBy("_g", "_limit", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(upto), F.lit(0))
        # a cell in which the running count passes a multiple of the limit is a slice of its own
        part = cells.withColumn("_part", F.floor(before / F.col("_limit")) + F.floor((before + F.col("_n")) / F.col("_limit")))
        first = part.groupBy("_g", "_part").agg(F.min("_cell").alias("_cell"))
        cuts = stored(first.groupBy("_g").agg(F.sort_array(F.collect_list("_cell")).alias("_cuts")).join(full, "_g"), "slice-cuts")
        stuck = cuts.where(F.size("_cuts") < 2).select("_g")  # all in one cell: its place is too fine for a double
        wide = out.withColumn("_g", group).withColumns({f"_v{i}": places[c] for i, c in enumerate(usable)})
        wide = wide.join(F.broadcast(cuts), "_g", "left")
        sub = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= cell)), F.lit(0))
        out = wide.select(*[F.col(c) for c in out.columns], sub.alias(f"_s{level}"))
        names.append(f"_s{level}")
        stuck = stuck.select(F.struct(*[F.col(f"_g.{n}") for n in names[:-1]], F.lit(1).alias(names[-1]), *[F.col(f"_g.{k}") for k in keys]).alias("_g"))
        if done is not None:
            done = done.select(F.struct(*[F.col(f"_g.{n}") for n in names[:-1]], F.lit(0).alias(names[-1]), *[F.col(f"_g.{k}") for k in keys]).alias("_g"))
            stuck = stuck.unionByName(done)
        done = stored(stuck, "stuck-slices")
    return out.select(*[F.col(c) for c in df.columns], F.struct(*names).alias("_slice"))


def ordinal_running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    sums: Mapping[str, Column] | None = None, *, idx_col: str = "idx",
                    width: int | None = None, limit: int | None = None, keep_slice: bool = False) -> DataFrame:
    """Add the 1-based position of each row inside `keys` ordered by `order`
    (which must be a total order within a key) and running sums of `sums`.

    The first column of `order` is a date, a timestamp or a number. One
    exchange of the rows on (slice, keys), used by the local windows and by
    the join with the small table of slice offsets. The join key is a
    struct, in which NULL equals NULL.
    """
    keys, order, sums = list(keys), list(order), dict(sums or {})
    base = df.select("*", *[c.alias(f"_v_{n}") for n, c in sums.items()])
    r = balanced_slices(base, keys, order, width, limit).withColumn("_k", F.struct("_slice", *keys))
    wl = (Window.partitionBy("_k").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = r.select("*", F.count(F.lit(1)).over(wl).alias("_l_n"),
                     *[F.sum(f"_v_{n}").over(wl).alias(f"_l_{n}") for n in sums])
    tot = r.groupBy("_k").agg(F.count(F.lit(1)).alias("_t_n"),
                              *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    wo = (Window.partitionBy(*[F.col(f"_k.{k}") for k in keys]).orderBy("_k._slice")
          .rowsBetween(Window.unboundedPreceding, -1))
    off = tot.select("_k", F.coalesce(F.sum("_t_n").over(wo), F.lit(0)).alias("_o_n"),
                     *[F.coalesce(F.sum(f"_t_{n}").over(wo), F.lit(0)).alias(f"_o_{n}") for n in sums])
    j = local.join(off, on="_k", how="inner")
    return j.select(*[F.col(c) for c in df.columns], (F.col("_l_n") + F.col("_o_n")).alias(idx_col),
                    *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums],
                    *([F.col("_k._slice").alias("_slice")] if keep_slice else []))


def shifted(df: DataFrame, keys: Sequence[str], idx_col: str, by: int,
            cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Value of `cols` from the row `by` positions earlier (lag by index).

    A 1:1 equi-join on (keys, idx - by): the join key includes the position,
    so a large group is spread over all partitions.
    """
    keys = list(keys)
    here = df.withColumn("_k", F.struct(*keys, F.col(idx_col).alias("_i")))
    other = df.select(F.struct(*keys, (F.col(idx_col) + by).alias("_i")).alias("_k"),
                      *[F.col(c).alias(prefix + c) for c in cols])
    return here.join(other, on="_k", how="left").drop("_k")


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int, order: Sequence[str] = (),
               count_col: str = "num_hits", width: int | None = None, limit: int | None = None) -> DataFrame:
    """Batch sessions per key: a new session starts when the time since the
    key's previous event exceeds `gap_seconds` (exactly one gap still
    merges, as Spark's session windows do); a session ends `gap_seconds`
    after its last event. NULL keys have sessions too.

    Skew-safe: rows are cut into balanced slices along the time; inside each
    (slice, key) a local window flags starts, counting the slice's first
    row as a start provisionally; a small table with one row
    per (slice, key) fixes that first row from the previous slice's last
    event and turns the flags into global session numbers. Sessions are
    then a partial aggregate on (key, session number).
    """
    keys = list(keys)
    order = [ts, *order]
    secs = F.col(ts).cast("timestamp").cast("double")   # seconds; timestamp_ntz read in the session time zone
    cut = balanced_slices(df.select(*keys, *[c for c in order if c not in keys]), keys, order, width, limit)
    r = cut.select(*order, secs.alias("_t"), F.struct("_slice", *keys).alias("_k"))
    wl = Window.partitionBy("_k").orderBy(*order)
    prev_t = F.lag("_t").over(wl)
    start = F.when(prev_t.isNull() | (F.col("_t") - prev_t > gap_seconds), 1).otherwise(0)
    local = r.select("*", start.alias("_start"))
    local = local.select("*", F.sum("_start").over(wl.rowsBetween(Window.unboundedPreceding, 0)).alias("_l_sid"))
    per = local.groupBy("_k").agg(F.min("_t").alias("_first_t"), F.max("_t").alias("_last_t"),
                                  F.sum("_start").alias("_prov"))
    wo = Window.partitionBy(*[F.col(f"_k.{k}") for k in keys]).orderBy("_k._slice")
    prev_last = F.lag("_last_t").over(wo)
    # the slice's first row is a true start unless the previous slice's last event is within the gap
    first_true = F.when(prev_last.isNotNull() & (F.col("_first_t") - prev_last <= gap_seconds), 0).otherwise(1)
    fixed = per.select("_k", (first_true - 1).alias("_fix"), (F.col("_prov") + first_true - 1).alias("_true"))
    off = fixed.select("_k", "_fix", F.coalesce(F.sum("_true").over(wo.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0)).alias("_off"))
    j = local.join(off, on="_k", how="inner")
    sid = F.col("_off") + F.col("_l_sid") + F.col("_fix")
    rows = j.select(*[F.col(f"_k.{k}").alias(k) for k in keys], ts, sid.alias("_sid"))
    g = rows.groupBy(*keys, "_sid").agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last"),
                                        F.count(F.lit(1)).alias(count_col))
    return g.select(*keys, "session_start",
                    (F.col("_last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"), count_col)
