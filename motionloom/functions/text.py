"""Column functions on dates in names, paths, rates, labels and payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def compact_date(x: Column) -> Column:
    """The first 20yymmdd in a name as yyyy-mm-dd; the calendar is not consulted."""
    d = blank_to_null(F.regexp_extract(x, r"(20\d{6})", 1))
    return F.when(d.isNotNull(), F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2)))


def iso_date(x: Column, prefix_only: bool = False) -> Column:
    return blank_to_null(F.regexp_extract(x, r"^(\d{4}-\d{2}-\d{2})" if prefix_only else r"(\d{4}-\d{2}-\d{2})", 1))


def source_date(candidates: Sequence[Column], default: str | None = "unknown") -> Column:
    """The first candidate that has a compact date or, failing that, an ISO date."""
    found = [F.coalesce(compact_date(c), iso_date(c)) for c in candidates]
    return F.coalesce(*found, *([F.lit(default)] if default else []))


def frame_rate(x: Column) -> Column:
    """`30000/1001` or `10`; null for what is no number and for a zero denominator."""
    parts = F.split(x, "/")
    top, low = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    return F.when(F.size(parts) == 1, top).when(F.size(parts) == 2, F.try_divide(top, low))


def path_component(x: Column, fallback: str = "unnamed") -> Column:
    """The last part of a path with everything but letters, digits, `_.-` as one `_`, without `._-` at its ends."""
    base = F.element_at(F.split(F.rtrim(x, F.lit("/")), "/"), -1)
    safe = F.regexp_replace(F.regexp_replace(base, r"[^A-Za-z0-9_.-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.coalesce(blank_to_null(safe), F.lit(fallback))


def last_dotted(x: Column) -> Column:
    return F.element_at(F.split(x, r"\."), -1)


def validity_label(x: Column) -> Column:
    return F.when(x, "valid").when(~x, "invalid")


def task_text(*candidates: Column, default: str = "teleop") -> Column:
    """The first that is not blank, trimmed."""
    return F.coalesce(*[blank_to_null(F.trim(c)) for c in candidates], F.lit(default))


def data_path(index: Column, chunk_size: int = 1000, *given: Column) -> Column:
    """A path that the metadata gives, else the one of the layout."""
    chunk = F.floor(index / F.lit(max(1, chunk_size))).cast("bigint")
    return F.coalesce(*given, F.format_string("data/chunk-%03d/episode_%06d.parquet", chunk, index))


def routing(path: Column, robot_type: Column | None = None) -> Column:
    """struct(hardware, mission) that a dataset's path and its robot's type name: the first path part that begins with
    `mission`, and a hardware part of the path, else a hardware name within the type."""
    parts, kind = F.split(path, "/"), F.lower(robot_type) if robot_type is not None else F.lit("")
    low = F.transform(parts, F.lower)
    # The known rigs, and the names of what is not known.
    hardware = F.when(F.array_contains(low, "nero"), "nero").when(F.array_contains(low, "rokae"), "rokae").when(kind.contains("nero"), "nero").when(kind.contains("rokae") | kind.contains("xmate"), "rokae").otherwise("unknown_hardware")
    mission = F.coalesce(F.get(F.filter(parts, lambda x: x.startswith("mission")), F.lit(0)), F.lit("mission_unspecified"))
    return F.struct(hardware.alias("hardware"), path_component(mission, "mission_unspecified").alias("mission"))


def output_label(path: Column) -> Column:
    """The label of a dataset's reports: the part that ends in `_by_date` with the two after it, else the last two parts."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    n = F.size(parts)
    at = F.array_position(F.transform(parts, lambda x, i: x.endswith("_by_date") & (i + 2 < n)), F.lit(True)).cast("int")
    return F.when(at > 0, F.array_join(F.slice(parts, at, F.lit(3)), "_")).when(n >= 2, F.array_join(F.slice(parts, n - 1, F.lit(2)), "_")).otherwise(F.coalesce(F.get(parts, F.lit(0)), F.lit("")))


def shown_vector(v: Column, most: int = 6) -> Column:
    """A vector for reading: its first components with four decimals, and its width."""
    first = F.array_join(F.transform(F.slice(v, 1, most), lambda x: F.format_string("%.4f", x)), ", ")
    return F.concat(F.lit("["), first, F.when(F.size(v) > most, ", ...").otherwise(""), F.lit("] shape=("), F.size(v).cast("string"), F.lit(",)"))


def vector_of_json(json: Column, width: int) -> Column:
    """A JSON list of numbers as a vector, or null where it isn't one of this width."""
    v = F.from_json(json, "array<double>")
    return F.when((F.size(v) == width) & F.forall(v, lambda x: x.isNotNull()), v)


def date_matches(date: str, kind: str, dates: dict[str, Column]) -> Column:
    """Whether a row is of a date: kind names one of its dates, or is `any`."""
    if kind == "any":
        return F.coalesce(F.array_contains(F.array_compact(F.array(*dates.values())), date), F.lit(False))
    return F.coalesce(dates[kind] == date, F.lit(False))


# The names of the action's dimensions, in stored order.
ACTION_NAMES = (
    ["eef_x", "eef_y", "eef_z", *[f"eef_rot6d_{k}" for k in range(6)]]
    + ["thumb_cmc_pitch", "thumb_cmc_yaw", "index_mcp_pitch", "middle_mcp_pitch", "ring_mcp_pitch", "pinky_mcp_pitch", "index_mcp_roll", "ring_mcp_roll", "pinky_mcp_roll", "thumb_cmc_roll"]
    + [f"arm_joint_{k}" for k in range(7)]
)


def action_name(dim: Column) -> Column:
    """The name of an action dimension; `dim_<n>` beyond the known ones."""
    return F.coalesce(F.get(F.array(*map(F.lit, ACTION_NAMES)), dim.cast("int")), F.concat(F.lit("dim_"), dim.cast("string")))


def action_group(dim: Column) -> Column:
    """Of a relative action's dimension."""
    return F.when(dim < 3, "eef_xyz").when(dim < 9, "eef_rot6d").when(dim < 19, "hand_joint_target").otherwise("arm_joint_target")


def with_prefix(x: Column, prefix: str) -> Column:
    return F.when(x.startswith(prefix), x).otherwise(F.concat(F.lit(prefix), x))


def camera_matches(name: Column, wanted: str, aliases: dict[str, str]) -> Column:
    """Equal, or one the alias of the other."""
    both = {wanted, *(b for a, b in aliases.items() if a == wanted), *(a for a, b in aliases.items() if b == wanted)}
    return name.isin(*sorted(both))


def fingerprint(**parts: Column) -> Column:
    """SHA-256 of the JSON of the parts in the order of their names; nulls are kept as nulls."""
    row = F.struct(*[parts[k].alias(k) for k in sorted(parts)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def named_values(names: Column, values: Column, order: Sequence[str]) -> Column:
    """Values by name in a fixed order; the last of repeated names counts; null unless every name has a number."""
    pairs = F.arrays_zip(names.alias("n"), values.alias("v"))
    own = lambda k: F.transform(F.filter(pairs, lambda p: p["n"] == k), lambda p: p["v"])
    picked = F.transform(F.array(*map(F.lit, order)), lambda k: F.try_element_at(own(k), F.lit(-1)))
    return F.when((F.size(names) == F.size(values)) & ~F.exists(picked, lambda x: x.isNull()), picked)


def rounded_or_null(x: Column, digits: int = 6) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.bround(x, digits))


def numeric_items(value: Column) -> Column:
    """Of a variant that is a list its numbers, as doubles in order; true and false count as 1 and 0, all else is left out.
    Of any other value, null too, an empty list."""
    items = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))
    kind = lambda x: F.schema_of_variant(x)
    number = lambda x: F.when(kind(x) == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("double")).when(kind(x).isin("BIGINT", "DOUBLE", "FLOAT") | kind(x).startswith("DECIMAL"), F.try_variant_get(x, "$", "double"))
    return F.filter(F.transform(items, number), lambda x: x.isNotNull())
