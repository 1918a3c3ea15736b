"""Data-quality report over enriched transactions.

Each rule is a row-level test written as SQL text. One aggregate pass counts the failures of
every rule; a second pass, over failing rows only, fetches up to five distinct bad values per
rule. The second pass removes duplicates map-side and ranks with a group limit, so a rule that
fails on every row still sends only five values per task. The table is read twice: hand in a
stored one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast import constants as K
from demandcast.operators.clean import missing_columns
from demandcast.session import local_table


@dataclass(frozen=True)
class Rule:
    """``ok`` is a SQL condition (NULL counts as failing), ``value`` the SQL text to show."""

    column: str
    check: str
    ok: str
    value: str
    details: str


def _text(df: DataFrame, c: str) -> str:
    """The value as the report prints it; zoned timestamps show their offset."""
    if isinstance(df.schema[c].dataType, T.TimestampType):
        return f"date_format(`{c}`, 'yyyy-MM-dd HH:mm:ss.SSSSSSxxx')"
    return f"CAST(`{c}` AS STRING)"


def _number(df: DataFrame, c: str) -> str:
    if isinstance(df.schema[c].dataType, T.NumericType):
        return f"CAST(`{c}` AS DOUBLE)"
    text = f"trim(CAST(`{c}` AS STRING))"
    return f"CASE WHEN {text} RLIKE r'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' THEN try_cast({text} AS DOUBLE) END"


def _pair(a: str, b: str) -> str:
    return f"concat_ws(' | ', coalesce(CAST(`{a}` AS STRING), 'nan'), coalesce(CAST(`{b}` AS STRING), 'nan'))"


def _names(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def enriched_rules(df: DataFrame, payment_types: Sequence[str] = K.PAYMENT_TYPES) -> list[Rule]:
    """All rules that apply to the columns at hand."""
    have = set(df.columns)
    rules: list[Rule] = []

    def add(c: str, check: str, ok: str, details: str, value: str | None = None) -> None:
        rules.append(Rule(c, check, ok, value or _text(df, c), details))

    def matches(c: str, pattern: str) -> str:
        return f"{_text(df, c)} RLIKE r'{pattern}'"

    def within(c: str, check: str, lo: float, hi: float, details: str) -> None:
        add(c, check, f"({_number(df, c)}) BETWEEN {lo}D AND {hi}D", details)

    for c in ("date", "_date_local"):
        if c in have:
            add(c, "iso_date_string", matches(c, K.ISO_DATE), "a calendar day written year-month-day")
    for c in ("datetime", "dt_local"):
        if c in have:
            add(c, "iso_datetime_with_tz", matches(c, K.ISO_DATETIME_TZ), "date and time followed by an offset")
    if "cash_type" in have:
        add("cash_type", "allowed_values", f"`cash_type` IN ({_names(payment_types)})", f"one of {', '.join(sorted(payment_types))}")
    if "card" in have:
        add("card", "anonymized_pattern", f"`card` IS NULL OR {matches('card', K.ANONYMISED_CARD)}",
            "no value, or a masked card number")
    if "money" in have:
        add("money", "numeric_non_negative", f"({_number(df, 'money')}) >= 0", "a number that is not below zero")
    for c in K.INTEGER_COLUMNS:
        if c in have:
            add(c, "integer_like", f"({_number(df, c)}) % 1 = 0", "a number without a fraction")
    for c in K.FLOAT_COLUMNS:
        if c in have:
            add(c, "numeric", f"({_number(df, c)}) IS NOT NULL", "readable as a number")
    for c, (lo, hi) in K.VALUE_RANGES.items():
        if c in have:
            within(c, "value_range", lo, hi, f"from {lo} to {hi}")
    for c in ("month_sin", "month_cos", "hour_sin", "hour_cos"):
        if c in have:
            within(c, "trig_range", -1.0000001, 1.0000001, "a sine or cosine")
    for base, period, offsets in (("month", 12, (1, 0)), ("hour", 24, (0,))):
        parts = {f"{base}_sin": "sin", f"{base}_cos": "cos"}
        if {base, *parts} <= have:
            n = _number(df, base)
            for c, fn in parts.items():
                close = " OR ".join(
                    f"abs(({_number(df, c)}) - {fn}((({n}) - {off}) * {2 * math.pi / period}D)) <= 1e-6D" for off in offsets)
                add(c, f"consistency_with_{base}", f"({n}) IS NULL OR {close}", f"equals the wave of {base}, counted from one or from zero" if len(offsets) > 1 else f"equals the wave of {base}")
    if "dt_local" in have:
        add("dt_local", "hour_floor_alignment", matches("dt_local", K.ON_THE_HOUR), "stands on a full hour")
    if "datetime" in have:
        add("datetime", "timezone_aware", matches("datetime", K.HAS_OFFSET), "names its zone")
    for c, (lo, hi) in K.PHYSICAL_RANGES.items():
        if c in have:
            within(c, "physical_plausibility", lo, hi, f"physically possible: {lo} to {hi}")
    if {"wx_precipitation", "wx_rain"} <= have:
        p, r = _number(df, "wx_precipitation"), _number(df, "wx_rain")
        both = f"({p}) >= 0 AND ({r}) >= 0"
        add("wx_precipitation", "non_negative", both, "neither amount is below zero")
        add("wx_rain", "non_negative", both, "neither amount is below zero", _text(df, "wx_precipitation"))
        add("wx_rain", "rain_leq_total_precip", f"({r}) <= ({p})", "no more rain than precipitation of all kinds", _pair("wx_rain", "wx_precipitation"))
    if "is_holiday" in have:
        is_bool = isinstance(df.schema["is_holiday"].dataType, T.BooleanType)
        add("is_holiday", "boolean_type", "TRUE" if is_bool else "`is_holiday` IS NULL", "true or false")
    if {"is_holiday", "holiday_name"} <= have:
        name = "lower(trim(CAST(`holiday_name` AS STRING)))"
        named = f"coalesce({name} NOT IN ({_names(K.EMPTY_NAMES)}), FALSE)"
        flag = "CAST(`is_holiday` AS BOOLEAN)"
        add("holiday_name", "consistency_with_is_holiday", f"{flag} IS NULL OR {flag} = {named}",
            "named if and only if flagged", _pair("is_holiday", "holiday_name"))
    if "coffee_name" in have:
        add("coffee_name", "non_empty", "`coffee_name` IS NULL OR length(`coffee_name`) > 0", "has at least one character")
    return rules


def failure_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of failing rows, from a single aggregate pass."""
    counts = ", ".join(f"count_if(NOT coalesce({r.ok}, FALSE))" for r in rules)
    counted = df.agg(F.expr(f"array({counts})").alias("_n")).select(F.posexplode("_n").alias("rule", "n_bad"))
    about = local_table(df.sparkSession, [(i, r.column, r.check, r.details) for i, r in enumerate(rules)],
                        rule=pa.int32(), column=pa.string(), check=pa.string(), details=pa.string())
    # Both sides have one row per rule.
    return about.join(F.broadcast(counted), "rule")


def bad_samples(df: DataFrame, rules: Sequence[Rule], n: int = 5) -> DataFrame:
    """Up to ``n`` distinct bad values per rule, the smallest in text order."""
    values = ", ".join(f"CASE WHEN NOT coalesce({r.ok}, FALSE) THEN coalesce({r.value}, 'nan') END" for r in rules)
    found = f"filter(transform(array({values}), (v, i) -> struct(i AS rule, v AS value)), s -> s.value IS NOT NULL)"
    bad = df.select(F.explode(F.expr(found)).alias("b")).select("b.rule", "b.value").distinct()
    w = Window.partitionBy("rule").orderBy("value")
    few = bad.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return few.groupBy("rule").agg(F.sort_array(F.collect_list("value")).alias("sample_bad_values"))


def validate_enriched(df: DataFrame, expected: Sequence[str] = K.ENRICHED_COLUMNS,
                      rules: Sequence[Rule] | None = None) -> DataFrame:
    """The full report: column, check, status, details, sample_bad_values, n_bad."""
    rules = enriched_rules(df) if rules is None else rules
    counts = failure_counts(df, rules)
    report = counts.join(F.broadcast(bad_samples(df, rules)), "rule", "left").drop("rule")
    absent = missing_columns(df, expected)
    note = f"Missing columns: {absent}" if absent else "All expected columns present"
    presence = df.sparkSession.createDataFrame(
        [("__all__", "columns_present", note, len(absent), None)],
        "`column` string, `check` string, details string, n_bad long, sample_bad_values array<string>")
    full = presence.unionByName(report)
    ok = F.col("n_bad") == 0
    return full.select(
        "column", "check", F.when(ok, "OK").otherwise("FAIL").alias("status"),
        F.when(ok, F.col("details")).otherwise(F.concat(F.lit("Problem found: "), "details")).alias("details"),
        "sample_bad_values", "n_bad").orderBy("status", "column", "check")
