"""Row-wise expressions: labels, names, times, missing categories, parameter names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "<missing>"


def binary_label(target: Column, positive: str = "bad") -> Column:
    """1 for the positive class, 0 for every other value; a missing target is an error."""
    return F.when(
        target.isNull(), F.raise_error(F.lit("target is missing")).cast("int")
    ).otherwise((target == positive).cast("int"))


def run_name(start: Column) -> Column:
    """A run is named after the second it started in."""
    return F.date_format(start, "yyyy_MM_dd_HH_mm_ss")


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def elapsed_seconds(start: Column, end: Column) -> Column:
    return (_micros(end) - _micros(start)) / F.lit(1e6)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def fill_missing(category: Column) -> Column:
    return F.coalesce(category, F.lit(MISSING))


def clean_feature_name(name: Column) -> Column:
    """Drop the column-group prefix of an encoded feature."""
    return F.regexp_replace(name, "(non_)?numeric__", "")


def _without_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def friendly_param_name(path: Column) -> Column:
    """Short name of a parameter path, e.g. ``prep__numeric__imputer__transformer`` -> imputer."""
    suffix = "__transformer"
    step = F.substr(path, F.lit(1), F.length(path) - len(suffix))
    step = _without_prefix(_without_prefix(step, "prep__numeric__"), "prep__non_numeric__")
    return (
        F.when(
            path == "prep__savings_status__savings_encoder__transformer", "savings_status_encoder"
        )
        .when(path.startswith("model__"), _without_prefix(path, "model__"))
        .when(path.endswith(suffix), step)
        .otherwise(path)
    )


def friendly_params(params: Column) -> Column:
    """The map with short keys. Paths are visited with ``prep__`` last; the first name wins."""
    entries = F.map_entries(params)
    ordered = F.concat(
        F.filter(entries, lambda e: ~e["key"].startswith("prep__")),
        F.filter(entries, lambda e: e["key"].startswith("prep__")),
    )
    renamed = F.transform(
        ordered,
        lambda e: F.struct(friendly_param_name(e["key"]).alias("key"), e["value"].alias("value")),
    )
    nothing = F.create_map().cast("map<string, string>")
    return F.aggregate(
        renamed,
        nothing,
        lambda kept, e: F.when(F.map_contains_key(kept, e["key"]), kept).otherwise(
            F.map_concat(kept, F.create_map(e["key"], e["value"]))
        ),
    )


def param_value(params: Column, name: str) -> Column:
    """The value of one parameter by its short name, looked up under the paths it may have."""
    paths = [
        f"model__{name}",
        name,
        f"prep__numeric__{name}__transformer",
        f"prep__non_numeric__{name}__transformer",
    ]
    if name == "savings_status_encoder":
        paths.append("prep__savings_status__savings_encoder__transformer")
    return F.coalesce(*[F.try_element_at(params, F.lit(path)) for path in paths])


def without_model(params: Column) -> Column:
    """The params that are logged: all but the model object itself."""
    return F.map_filter(params, lambda key, _: key != "model")
