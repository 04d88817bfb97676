"""Data-quality rules.

A rule is a name and a predicate that is true for a bad row. All rules of a table are
counted in one aggregation pass; only the counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trackmart.schemas import DIM_FLIGHT_LENGTHS, DIM_STATION_LENGTHS
from trackmart.sources.snapshots import poll_time, readable


class Rule(NamedTuple):
    name: str
    broken: Column


class Violation(NamedTuple):
    rule: str
    rows: int


class DataQualityError(ValueError):
    """Raised with the first broken rule; ``violations`` lists all of them."""

    def __init__(self, violations: list[Violation]):
        super().__init__(f"data quality: {violations[0].rule} broken by {violations[0].rows} row(s)")
        self.violations = violations


def state_rules() -> list[Rule]:
    return [
        Rule("states_icao24_null", F.col("icao24").isNull()),
        Rule("states_velocity_negative", F.col("velocity") < 0),
    ]


def payload_rules(value: str = "value") -> list[Rule]:
    """On raw payloads: every line is JSON and has a time, and no aircraft occurs twice in it."""
    ids = F.transform(
        F.from_json(value, "states ARRAY<ARRAY<STRING>>")["states"], lambda vector: F.get(vector, F.lit(0))
    )
    return [
        Rule("payload_unreadable", ~readable(value)),
        Rule("payload_time_missing", readable(value) & poll_time(value).isNull()),
        Rule("payload_aircraft_repeated", F.size(ids) != F.size(F.array_distinct(ids))),
    ]


def station_rules() -> list[Rule]:
    return [Rule("stations_id_null", F.col("station_id").isNull())]


def geometry_rules() -> list[Rule]:
    """Advisory: such stations are left out of the nearest join."""
    return [
        Rule("stations_geometry_null", F.col("lat").isNull() | F.col("lon").isNull() | F.col("h").isNull())
    ]


def target_rules() -> list[Rule]:
    return [Rule("points_station_null", F.col("station_id").isNull())]


def _too_long(limits: dict[str, int]) -> list[Rule]:
    return [Rule(f"{c}_too_long", F.length(c) > n) for c, n in limits.items()]


def dim_flight_rules() -> list[Rule]:
    return [Rule("icao24_null", F.col("icao24").isNull()), *_too_long(DIM_FLIGHT_LENGTHS)]


def dim_station_rules() -> list[Rule]:
    return [
        Rule("station_sk_null", F.col("station_sk").isNull()),
        Rule("station_id_null", F.col("station_id").isNull()),
        *_too_long(DIM_STATION_LENGTHS),
    ]


def marked(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, list[Rule]]:
    """``df`` with a column per rule, and the same rules on those columns: where a frame is kept,
    predicates that are dear are worked out once for all that asks for them."""
    rules = list(rules)
    return df.withColumns({r.name: r.broken for r in rules}), [Rule(r.name, F.col(r.name)) for r in rules]


def rule_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: (rule, violations), from a single pass over ``df``."""
    rules = list(rules)
    counts = df.agg(*[F.count_if(r.broken).alias(r.name) for r in rules])
    return counts.unpivot([], [r.name for r in rules], "rule", "violations")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def unique_rule(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """(rule, violations) where the violations are the number of repeated keys."""
    return duplicate_keys(df, key).agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations")


def source_checks(states: DataFrame, stations: DataFrame) -> DataFrame:
    """Rules on the raw inputs, in the order in which they are reported."""
    return (
        rule_counts(states, state_rules())
        .unionByName(unique_rule(states, ["icao24", "snapshot_ts"], "states_point_repeated"))
        .unionByName(rule_counts(stations, station_rules()))
    )


def target_checks(clean: DataFrame, points: DataFrame) -> DataFrame:
    """The nearest join must neither lose nor multiply points nor leave one without station.

    The first rule counts the difference in rows; it is what an empty station set breaks.
    """
    before = clean.agg(F.count("*").alias("n")).select(F.col("n").alias("rows_before"), F.lit(0).alias("rows_after"))
    after = points.agg(F.count("*").alias("n")).select(F.lit(0).alias("rows_before"), F.col("n").alias("rows_after"))
    difference = (
        before.unionByName(after)
        .agg(F.abs(F.sum("rows_before") - F.sum("rows_after")).alias("violations"))
        .select(F.lit("points_count_changed").alias("rule"), "violations")
    )
    return difference.unionByName(rule_counts(points, target_rules()))


def observed(df: DataFrame, rules: Iterable[Rule] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with its rows and the violations of ``rules`` counted while it is first computed."""
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(r.broken).alias(r.name) for r in rules]]
    observation = Observation()
    return df.observe(observation, *counts), observation


def target_violations(clean: Observation, points: Observation) -> list[Violation]:
    """``target_checks`` from what was counted while the points were located and written."""
    counts = {"points_count_changed": abs(clean.get["rows"] - points.get["rows"])}
    counts |= {r.name: points.get[r.name] for r in target_rules()}
    return [Violation(name, n) for name, n in counts.items() if n]


def dim_flight_checks(dim: DataFrame) -> DataFrame:
    return rule_counts(dim, dim_flight_rules()).unionByName(unique_rule(dim, ["icao24"], "icao24_repeated"))


def dim_station_checks(dim: DataFrame) -> DataFrame:
    return (
        rule_counts(dim, dim_station_rules())
        .unionByName(unique_rule(dim, ["station_sk"], "station_sk_repeated"))
        .unionByName(unique_rule(dim, ["station_id", "valid_from"], "station_version_repeated"))
    )


def guard(df: DataFrame, name: str) -> DataFrame:
    """(rule, violations) with one violation when ``df`` has no row."""
    return df.agg((F.count("*") == 0).cast("long").alias("violations")).select(F.lit(name).alias("rule"), "violations")


def run_checks(checks: DataFrame) -> list[Violation]:
    """Broken rules of a checks frame (a handful of rows)."""
    return [Violation(r.rule, r.violations) for r in checks.collect() if r.violations]


def run_rules(df: DataFrame, rules: Iterable[Rule]) -> list[Violation]:
    return run_checks(rule_counts(df, rules))


def require(violations: list[Violation]) -> None:
    if violations:
        raise DataQualityError(violations)


def require_rows(df: DataFrame, name: str) -> None:
    """Fail when ``df`` is empty; reads no further than the first row."""
    if df.isEmpty():
        raise DataQualityError([Violation(name, 1)])
