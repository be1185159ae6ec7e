"""Validation, quarantine, run counters and table checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Physical and plausibility bounds.
MIN_TEMPERATURE_C, MAX_TEMPERATURE_C = -60, 60
MAX_GENERATION_MW = 200_000

Rule = tuple[Column, str]


def _missing(name: str) -> Column:
    return F.col(name).isNull()


# The reasons below and their order are fixed values as well.


def carbon_rules() -> list[Rule]:
    return [
        (_missing("region_code"), "missing region_code"),
        (_missing("period_start"), "invalid period_start timestamp"),
        (_missing("period_end"), "invalid period_end timestamp"),
        (_missing("intensity_forecast"), "missing intensity_forecast"),
    ]


def weather_rules() -> list[Rule]:
    temperature = F.col("temperature_c")
    return [
        (_missing("city"), "missing city"),
        (_missing("time_utc"), "invalid time_utc"),
        (_missing("temperature_c"), "missing temperature_2m"),
        (temperature < MIN_TEMPERATURE_C, "temperature below physical minimum"),
        (temperature > MAX_TEMPERATURE_C, "temperature above physical maximum"),
    ]


def generation_rules() -> list[Rule]:
    total = F.col("total_generation_mw")
    return [
        (_missing("country_code"), "missing country_code"),
        (_missing("period_start"), "invalid period_start"),
        (_missing("period_end"), "invalid period_end"),
        (_missing("total_generation_mw"), "missing total_generation_mw"),
        (total < 0, "negative total generation"),
        (total > MAX_GENERATION_MW, "unrealistic generation magnitude"),
        # A NULL array has a NULL size, so an absent mix must be counted as empty explicitly.
        (F.coalesce(F.size("generation_mix"), F.lit(0)) == 0, "empty generation_mix array"),
    ]


def validate(df: DataFrame, rules: list[Rule], all_reasons: bool = False) -> DataFrame:
    """Adds `reject_reason`, the first rule that fails (NULL when none does).

    With all_reasons, also `reject_reasons`: every failing rule, in rule order.
    """
    checked = df.withColumn(
        "reject_reason", F.coalesce(*[F.when(cond, F.lit(reason)) for cond, reason in rules])
    )
    if all_reasons:
        checked = checked.withColumn(
            "reject_reasons",
            F.array_compact(F.array(*[F.when(cond, F.lit(reason)) for cond, reason in rules])),
        )
    return checked


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid without the reason column, invalid with it)."""
    reason_columns = [c for c in ("reject_reason", "reject_reasons") if c in checked.columns]
    valid = checked.filter(F.col("reject_reason").isNull()).drop(*reason_columns)
    return valid, checked.filter(F.col("reject_reason").isNotNull())


def quarantine_rows(invalid: DataFrame, run_id: str, rejected_at: Column | None = None) -> DataFrame:
    """Rejected rows as the audit log stores them, tagged with the run that rejected them."""
    stamp = F.current_timestamp() if rejected_at is None else rejected_at
    return invalid.withColumn("reject_at_ts", stamp).withColumn("run_id", F.lit(run_id))


def counted(checked: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, counting rows as they pass: no extra pass over the data.

    After an action on the frame, `observation.get` holds parsed / valid / invalid.
    """
    observation = Observation(name)
    bad = F.col("reject_reason").isNotNull()
    return (
        checked.observe(
            observation,
            F.count(F.lit(1)).alias("parsed"),
            F.count_if(~bad).alias("valid"),
            F.count_if(bad).alias("invalid"),
        ),
        observation,
    )


def quality_counts(checked: DataFrame) -> DataFrame:
    """One row: bronze, parsed, valid and invalid counts (parsing keeps every bronze row)."""
    bad = F.col("reject_reason").isNotNull()
    return checked.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count(F.lit(1)).alias("parsed_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("invalid_rows"),
    )


def grain_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count against distinct natural keys (rows with a NULL key part are not keys)."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_natural_keys"),
    )


def profile(
    df: DataFrame,
    *,
    ts: str | None = None,
    keys: list[str] | None = None,
    distinct: dict[str, str] | None = None,
    not_null: dict[str, str] | None = None,
    measures: dict[str, Column] | None = None,
    by: list[str] | None = None,
    span_days: bool = False,
) -> DataFrame:
    """Table profile: row count, natural keys, time range, distinct and non-null counts, measures.

    `distinct` and `not_null` map output name to column; `measures` maps output name to an
    aggregate expression. Distinct counts of the whole table come from its rows grouped once by the
    columns they are about, so that no row is ever multiplied.
    """
    counted = {name: [c] for name, c in (distinct or {}).items()}
    if keys:
        counted["distinct_natural_keys"] = keys
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if by:
        aggs += [F.count_distinct(*map(F.col, columns)).alias(name) for name, columns in counted.items()]
    if ts:
        aggs += [F.min(ts).alias("earliest"), F.max(ts).alias("latest")]
    if ts and span_days:
        aggs.append(F.datediff(F.max(ts), F.min(ts)).alias("span_days"))
    aggs += [F.count(c).alias(name) for name, c in (not_null or {}).items()]
    aggs += [expr.alias(name) for name, expr in (measures or {}).items()]
    out = df.groupBy(*(by or [])).agg(*aggs)
    if by or not counted:
        return out
    grouped = df.groupBy(*dict.fromkeys(c for columns in counted.values() for c in columns)).agg(F.lit(1).alias("_one"))
    return out.select("*", *[_distinct_count(grouped, columns).alias(name) for name, columns in counted.items()])


def _distinct_count(df: DataFrame, columns: list[str]) -> Column:
    """Distinct combinations without a NULL among them, as a scalar."""
    return df.select(*columns).dropna().distinct().agg(F.count(F.lit(1))).scalar()


def null_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row; `columns` maps output name to the column whose NULLs are counted."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()])


def range_report(df: DataFrame, nulls: dict[str, str], value: str, digits: int = 2) -> DataFrame:
    """NULL counts plus rounded min / max / mean of one measure."""
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in nulls.items()],
        F.round(F.min(value), digits).alias("min_value"),
        F.round(F.max(value), digits).alias("max_value"),
        F.round(F.avg(value), digits).alias("avg_value"),
    )


def half_hour(ts: Column) -> Column:
    """0 or 30 as SMALLINT; any other minute fails the job."""
    minute = F.minute(ts)
    return F.when(minute.isin(0, 30), minute.cast("smallint")).otherwise(
        F.raise_error(
            F.concat(F.lit("half_hour must be 0 or 30, got "), minute.cast("string"))
        ).cast("smallint")
    )
