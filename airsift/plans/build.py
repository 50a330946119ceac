"""Raw zone to marts, in dependency order: in full, or from a month on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airsift.operators import city, daily, features, forecast, profiles, staging
from airsift.plans.audit import audited_checks
from airsift.plans.forecast_job import run_forecasts
from airsift.plans.versions import Draft
from airsift.sources.files import read_forecasts

Tables = dict[str, DataFrame]
REPORT_ONLY = "report_only"
DAY = "measurement_date"


@dataclass(frozen=True)
class Model:
    """A table of the build: how to derive it from earlier tables and how to store it."""

    name: str
    derive: Callable[[Tables], DataFrame]
    needs: tuple[str, ...]
    # Date column whose months are the table's folders; none for small tables.
    month_of: str | None = None
    tags: frozenset[str] = field(default_factory=frozenset)
    # Lazy models are derived again by each reader instead of being written.
    stored: bool = True
    # A day of the result depends on the same day of its inputs only.
    per_day: bool = False
    # Raw-sized tables are written by the tasks that read them, without a shuffle.
    in_place: bool = False
    # Mergeable state per month of the inputs, stored as ``<name>_state``; ``derive`` then reads that table.
    state: Callable[[Tables], DataFrame] | None = None
    # From all tables, the stored form and a first day: the months that change when inputs do from that day on.
    increment: Callable[[Tables, DataFrame, dt.date], DataFrame] | None = None


def _model(name, derive, needs, month_of=None, tags=(), stored=True, per_day=False, in_place=False, state=None, increment=None) -> Model:
    return Model(name, derive, tuple(needs), month_of, frozenset(tags), stored, per_day, in_place, state, increment)


# The staged readings are read by three marts, so their typed form is written once as
# Parquet: text archives are slow to parse and gzip files cannot be split. The enriched
# forms only add station columns, which no mart reads, and stay lazy.
MODELS = [
    _model("stg_measurements", lambda t: staging.stage_measurements(t["measurements_raw"]),
           ["measurements_raw"], DAY, per_day=True, in_place=True),
    _model("stg_weather", lambda t: staging.stage_weather(t["weather_raw"]),
           ["weather_raw"], DAY, per_day=True, in_place=True),
    _model("int_measurements_enriched", lambda t: staging.enrich_measurements(t["stg_measurements"], t["stations"]),
           ["stg_measurements", "stations"], DAY, stored=False, per_day=True),
    _model("int_weather_enriched", lambda t: staging.enrich_weather(t["stg_weather"], t["stations"]),
           ["stg_weather", "stations"], DAY, stored=False, per_day=True),
    _model("mart_daily_air_quality", lambda t: daily.mart_daily_air_quality(t["stg_measurements"], t["stations"]),
           ["stg_measurements", "stations"], DAY, per_day=True),
    _model("mart_daily_aqi", lambda t: daily.mart_daily_aqi(t["mart_daily_air_quality"]),
           ["mart_daily_air_quality"], DAY, per_day=True),
    _model("mart_daily_weather", lambda t: daily.mart_daily_weather(t["stg_weather"], t["stations"]),
           ["stg_weather", "stations"], DAY, per_day=True),
    _model("mart_aq_weather_daily",
           lambda t: daily.mart_aq_weather_daily(t["mart_daily_air_quality"], t["mart_daily_weather"]),
           ["mart_daily_air_quality", "mart_daily_weather"], DAY, per_day=True),
    _model("mart_lagged_features",
           lambda t: features.mart_lagged_features(t["mart_aq_weather_daily"], t["holidays"]),
           ["mart_aq_weather_daily", "holidays"], DAY,
           increment=lambda t, stored, first: features.lagged_features_since(t["mart_aq_weather_daily"], stored, t["holidays"], first)),
    _model("mart_feature_stats", lambda t: features.mart_feature_stats(t["mart_lagged_features"]),
           ["mart_lagged_features"], tags=[REPORT_ONLY]),
    _model("mart_health_summary", lambda t: city.mart_health_summary(t["mart_daily_air_quality"]),
           ["mart_daily_air_quality"]),
    _model("mart_exceedance_stats", lambda t: city.mart_exceedance_stats(t["mart_daily_air_quality"]),
           ["mart_daily_air_quality"]),
    _model("mart_annual_monthly_trend", lambda t: city.mart_annual_monthly_trend(t["mart_daily_air_quality"]),
           ["mart_daily_air_quality"], tags=[REPORT_ONLY]),
    _model("mart_monthly_profile",
           lambda t: profiles.monthly_profile_of(t["mart_monthly_profile_state"], t["stations"]),
           ["stg_measurements", "stations"], state=lambda t: profiles.monthly_state(t["stg_measurements"])),
    _model("mart_diurnal_profile",
           lambda t: profiles.diurnal_profile_of(t["mart_diurnal_profile_state"], t["stations"]),
           ["stg_measurements", "stations"], state=lambda t: profiles.diurnal_state(t["stg_measurements"])),
    _model("mart_pollutant_ratio", lambda t: daily.mart_pollutant_ratio(t["mart_daily_air_quality"]),
           ["mart_daily_air_quality"], tags=[REPORT_ONLY]),
    _model("mart_forecast_accuracy",
           lambda t: forecast.mart_forecast_accuracy(t["mart_daily_forecast"], t["mart_daily_air_quality"]),
           ["mart_daily_forecast", "mart_daily_air_quality"], "forecast_date", tags=[REPORT_ONLY]),
]


def selected_models(sources: Collection[str], exclude_tags: Collection[str] = ()) -> list[Model]:
    """Models without an excluded tag whose inputs are all available, in build order."""
    known, chosen = set(sources), []
    for model in MODELS:
        if set(model.needs) <= known and not model.tags & set(exclude_tags):
            chosen.append(model)
            known.add(model.name)
    return chosen


def raw_since(raw: DataFrame, first_day: dt.date) -> DataFrame:
    """Raw rows that may belong to ``first_day`` or later, by the archive's folder columns where it has them.

    Folders go by local time and days by UTC, hence one day more.
    """
    from_day = first_day - dt.timedelta(days=1)
    if {"year", "month"} <= set(raw.columns):
        return raw.where(F.concat_ws("-", "year", F.lpad("month", 2, "0")) >= from_day.strftime("%Y-%m"))
    if "day" in raw.columns:
        return raw.where(F.col("day") >= from_day.isoformat())
    return raw


def build_into(
    draft: Draft, sources: Tables, exclude_tags: Collection[str] = (), since: dt.date | None = None
) -> tuple[Tables, Tables]:
    """Derive and write every selected model as part of ``draft``; nothing is visible to readers before its commit.

    Returns all tables, and of those whose earlier months stayed as they were, the months that did not.
    """
    tables, recent = dict(sources), dict(sources)
    first_day = since.replace(day=1) if since else None
    if first_day is not None:
        for name in {"measurements_raw", "weather_raw"} & set(sources):
            recent[name] = raw_since(sources[name], first_day)
    stored_before = draft.before.tables()
    bounded: set[str] = set()
    for model in selected_models(sources, exclude_tags):
        # A table that no run has written yet is derived from all months, whatever the caller's bound.
        state_name = f"{model.name}_state"
        touched_only = first_day is not None and (
            model.per_day and (not model.stored or model.name in stored_before) or model.state is not None and state_name in stored_before
        )
        given = recent if touched_only else tables
        month_bound = first_day if touched_only else None
        if touched_only and model.per_day:
            bounded.add(model.name)
        if model.state is not None:
            state = model.state(given)
            tables[state_name] = draft.write(state_name, state, profiles.STATE_MONTH, month_bound)
            given = tables
        derived = model.derive(given)
        if not model.stored:
            tables[model.name] = model.derive(tables)
            recent[model.name] = derived
            continue
        if first_day is not None and model.increment is not None and model.name in stored_before:
            changed = model.increment(tables, draft.open(model.name, derived.schema), first_day)
            tables[model.name] = recent[model.name] = draft.write(model.name, changed.select(*derived.columns), model.month_of, first_day)
            continue
        if model.month_of is None:
            tables[model.name] = recent[model.name] = draft.write(model.name, derived)
            continue
        if touched_only:
            derived = derived.where(F.col(model.month_of) >= F.lit(first_day))
        tables[model.name] = draft.write(model.name, derived, model.month_of, month_bound, model.in_place)
        recent[model.name] = tables[model.name]
        if first_day is not None:
            recent[model.name] = draft.open(model.name, derived.schema, model.month_of, first_day)
    return tables, {name: recent[name] for name in bounded}


def build_all(
    spark: SparkSession,
    sources: Tables,
    target: str,
    exclude_tags: Collection[str] = (),
    since: dt.date | None = None,
) -> Tables:
    """Derive and write every selected model under ``target``; return the stored tables.

    ``sources``: ``measurements_raw``, ``weather_raw``, ``stations``, ``holidays`` and,
    for forecast accuracy, ``mart_daily_forecast``. Each model reads its inputs back
    from storage, which cuts the lineage: losing an executor costs at most the work of
    one model. With ``since``, taken back to the first of its month, the per-day models
    and the state of the profiles read the archive's folders from then on only and
    replace whole months, also those that have no rows any more; the lagged features carry
    in the rows their windows need; earlier months stay and all other models are rebuilt
    from whole tables. A table that is not stored yet is built
    in full, so a first run needs no other call.

    The tables of a run appear together, when all are written (see ``versions``): if a run
    fails between two models, readers of ``versions.read_tables`` keep the run before.
    """
    return _built(spark, sources, target, exclude_tags, since)[0]


def _built(spark: SparkSession, sources: Tables, target: str, exclude_tags: Collection[str], since: dt.date | None) -> tuple[Tables, Tables]:
    draft = Draft(spark, target)
    tables, recent = build_into(draft, sources, exclude_tags, since)
    draft.commit()
    return tables, recent


def _checked(spark: SparkSession, tables: Tables, recent: Tables, target: str, as_of: dt.date, since: dt.date | None, models: Collection[str] = ()) -> DataFrame:
    days = {model.name: model.month_of for model in MODELS if model.per_day}
    first_day = since.replace(day=1) if since else None
    return audited_checks(spark, tables, as_of, f"{target.rstrip('/')}/_audit", sorted(models), days, recent, first_day)


def build_and_check(
    spark: SparkSession,
    sources: Tables,
    target: str,
    as_of: dt.date,
    exclude_tags: Collection[str] = (REPORT_ONLY,),
    since: dt.date | None = None,
) -> tuple[Tables, DataFrame]:
    """Build, then check; failing rows are stored beside the marts and never stop the build."""
    tables, recent = _built(spark, sources, target, exclude_tags, since)
    return tables, _checked(spark, tables, recent, target, as_of, since)


def daily_run(
    spark: SparkSession,
    sources: Tables,
    target: str,
    as_of: dt.date,
    since: dt.date | None = None,
    fit: forecast.Fitter = forecast.LagDifference.fit,
    model: str = "lagdiff",
    known_models: Collection[str] = (),
) -> tuple[Tables, DataFrame]:
    """The whole day's work: build, forecast from its features, score all forecasts so far, check every table.

    The tables, accuracy among them, appear together. Forecast runs have folders of their own, added before.
    ``known_models`` are those that earlier runs under ``target`` may have stored.
    """
    draft = Draft(spark, target)
    tables, recent = build_into(draft, sources, since=since)
    run_forecasts(spark, tables["mart_lagged_features"], target, as_of, fit, model)
    tables["mart_daily_forecast"] = read_forecasts(spark, f"{target.rstrip('/')}/mart_daily_forecast")
    scored = [m for m in MODELS if m.name == "mart_forecast_accuracy"][0]
    tables[scored.name] = draft.write(scored.name, scored.derive(tables), scored.month_of)
    draft.commit()
    return tables, _checked(spark, tables, recent, target, as_of, since, {model, *known_models})
