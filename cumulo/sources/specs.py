"""Table contracts - columns and types, key, allowed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType, MapType, StringType, StructField,
                               StructType, TimestampNTZType)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: Sequence[str] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the spec's columns by name, cast to the spec's types (T9: never by position)."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows describing contract breaks: NULL or duplicate keys, values outside an enum.

        One aggregate per check; nothing is collected.
        """
        spark = df.sparkSession
        parts = []
        if self.key:
            null_key = None
            for k in self.key:
                c = F.col(k).isNull()
                null_key = c if null_key is None else null_key | c
            parts.append(df.filter(null_key).select(F.lit("null_key").alias("issue"),
                                                    F.to_json(F.struct(*self.key)).alias("detail")))
            parts.append(df.groupBy(*self.key).count().filter("count > 1")
                         .select(F.lit("duplicate_key").alias("issue"), F.to_json(F.struct(*self.key)).alias("detail")))
        for col, values in self.allowed.items():
            parts.append(df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
                         .select(F.lit(f"bad_{col}").alias("issue"), F.col(col).cast("string").alias("detail")))
        if not parts:
            return spark.createDataFrame([], "issue string, detail string")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


    def report(self, df: DataFrame) -> DataFrame:
        """table, check, num: rows, rows with a NULL in the key, keys that come more than once, and for each column
        with a fixed set of values the rows outside it. Two scans at most, whatever the number of checks."""
        null_key = F.lit(False)
        for k in self.key:
            null_key = null_key | F.col(k).isNull()
        checks = {"rows": F.count(F.lit(1)), "null_key": F.count_if(null_key)}
        checks |= {f"bad_{c}": F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in self.allowed.items()}
        one = df.agg(*[v.alias(k) for k, v in checks.items()]).unpivot([], list(checks), "check", "num")
        if self.key:
            repeated = df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("num"))
            one = one.unionByName(repeated.select(F.lit("duplicate_key").alias("check"), "num"))
        return one.select(F.lit(self.name).alias("table"), "check", "num")


_TYPES = {"long": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(), "date": DateType(),
          "timestamp_ntz": TimestampNTZType(), "array<date>": ArrayType(DateType()),
          "map<string,string>": MapType(StringType(), StringType())}


def columns(text: str) -> StructType:
    """`name type, name type, ...` as a schema; needs no session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in text.split(", "))])


# The growth-accounting table contract.
GROWTH_STATES = ("New", "Retained", "Resurrected", "Churned", "Stale")

# Contracts of the tables that the jobs read and write, as data.
_STATES = {"daily_active_state": GROWTH_STATES, "weekly_active_state": GROWTH_STATES}
CONTRACTS = {c.name: c for c in (
    TableSpec("web_events", columns("event_id long, user_id long, device_id long, host string, url string, referrer string, "
                                    "event_time timestamp_ntz, event_date date, value double"), ["event_id"],
              {"host": ("view", "click", "purchase", "signup", "error")}),
    TableSpec("player_seasons", columns("player_id long, season int, gp long, pts double, total double, total_cents long"),
              ["player_id", "season"]),
    TableSpec("actor_films", columns("actor_id long, film_id long, year int, votes long, rating double"), ["actor_id", "film_id"]),
    TableSpec("game_details", columns("game_id long, team_id long, player_id long, player_name string, team_abbreviation string"),
              ["game_id", "team_id", "player_id"]),
    TableSpec("users_cumulated", columns("user_id long, dates_active array<date>, date date"), ["user_id", "date"]),
    TableSpec("user_growth_accounting", columns("user_id long, first_active_date date, last_active_date date, daily_active_state string, "
                                                "weekly_active_state string, date date"), ["user_id", "date"], _STATES),
    TableSpec("vertices", columns("identifier string, type string, properties map<string,string>"), ["identifier", "type"],
              {"type": ("player", "team", "game")}),
    TableSpec("edges", columns("subject_identifier string, subject_type string, object_identifier string, object_type string, "
                               "edge_type string, properties map<string,string>"),
              ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"],
              {"edge_type": ("plays_against", "shares_team", "plays_in", "plays_on")}),
    TableSpec("experiment_cells", columns("user_id long, cell string"), ["user_id"], {"cell": ("control", "variant_a", "variant_b")}),
)}
