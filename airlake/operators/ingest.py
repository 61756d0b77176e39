"""Ingestion: validate API responses and flatten hourly arrays into events.

Responses arrive as JSON text, one row per (city, fetch). The text is parsed
once, to an untyped VARIANT: a typed parse turns "absent", "null" and "wrong
type" into the same NULL, and would drop a whole array for one bad element.
VARIANT refuses two things that common parsers take: the bare numbers ``NaN``,
``Infinity`` and ``-Infinity``, and repeated keys, of which the last one counts. Only
rows it refuses are parsed again, to a map of VARIANT fields that takes both.
Rules, first failure wins:

1. ``malformed_json``        the text is not JSON, even so
2. ``missing_hourly``        ``hourly`` is not an object (or there is no text)
3. ``missing_fields``        a required field is absent (present-but-null is *not* missing)
4. ``non_array_fields``      a required field is not an array (null, string, number...)
5. ``empty_time``            ``time`` has no entries
6. ``inconsistent_lengths``  arrays differ in length (NULL elements count)
7. ``unknown_city``          the city dimension has no such city (where one is given)

Flattening needs rule 6: ``arrays_zip`` would silently pad a short array.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.functions.timestamps import iso_utc_text, to_utc_wallclock
from airlake.schemas import CITY_COLUMNS, EVENT_COLUMNS, MEASURES, REQUIRED_HOURLY_FIELDS, SOURCE_NAME


def _field(hourly: Column, name: str, target: str) -> Column:
    return F.try_variant_get(hourly, f"$.{name}", target)


def _joined_names(conds: dict[str, Column]) -> Column:
    # concat_ws skips NULLs: names in required order, comma-separated
    return F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in conds.items()])


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a Generate node, so later filters cannot be rewritten
    into repeated evaluations of them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


_CORRUPT = {"columnNameOfCorruptRecord": "_corrupt"}


def _parsed_once(df: DataFrame, json_col: str) -> DataFrame:
    """Add ``_h`` (the text's ``hourly``, a VARIANT) and ``_malformed``."""
    text = F.col(json_col)
    staged = _once(df, _doc=F.try_parse_json(text))
    refused = text.isNotNull() & F.col("_doc").isNull()
    # entries of hourly, repeated ones too; the second parse tells "no object" from "no JSON"
    entries = F.from_json(text, "hourly map<string,variant>, _corrupt string", _CORRUPT)
    whole = F.from_json(text, "hourly variant, _corrupt string", _CORRUPT)
    staged = _once(staged, _again=F.when(refused, entries))
    no_map = F.col("_again._corrupt").isNotNull()
    malformed = refused & no_map & F.when(no_map, whole["_corrupt"].isNotNull())
    strict = F.try_variant_get(F.col("_doc"), "$.hourly", "variant")
    found = F.coalesce(strict, F.when(refused, _last_of_each(F.col("_again.hourly"))))
    return _once(staged, _h=found, _malformed=F.coalesce(malformed, F.lit(False)))


def _last_of_each(entries: Column) -> Column:
    """The required fields of a map that may repeat keys, as a VARIANT object."""
    names = F.filter(F.array(*[F.lit(f) for f in REQUIRED_HOURLY_FIELDS]), lambda f: F.array_contains(F.map_keys(entries), f))

    def last(name: Column) -> Column:
        own = F.filter(F.map_entries(entries), lambda e: e["key"] == name)
        return F.struct(name.alias("key"), F.element_at(own, -1)["value"].alias("value"))

    fields = F.map_from_entries(F.transform(names, last))
    return F.when(entries.isNotNull(), F.to_variant_object(fields))


def _verdict() -> tuple[Column, Column]:
    """(reject_reason, reject_fields) of a row with ``_h`` and ``_malformed``."""
    hourly = F.col("_h")
    is_object = F.coalesce(F.try_variant_get(hourly, "$", "map<string,variant>").isNotNull(), F.lit(False))
    missing = {f: _field(hourly, f, "variant").isNull() for f in REQUIRED_HOURLY_FIELDS}
    non_array = {f: _field(hourly, f, "array<variant>").isNull() for f in REQUIRED_HOURLY_FIELDS}
    sizes = [F.size(_field(hourly, f, "array<variant>")) for f in REQUIRED_HOURLY_FIELDS]
    any_missing = F.greatest(*missing.values())
    any_non_array = F.greatest(*non_array.values())
    unequal = F.greatest(*sizes) != F.least(*sizes)
    reason = (
        F.when(F.col("_malformed"), F.lit("malformed_json"))
        .when(~is_object, F.lit("missing_hourly"))
        .when(any_missing, F.lit("missing_fields"))
        .when(any_non_array, F.lit("non_array_fields"))
        .when(sizes[0] == 0, F.lit("empty_time"))
        .when(unequal, F.lit("inconsistent_lengths"))
    )
    fields = (
        F.when(~is_object, F.lit(None))
        .when(any_missing, _joined_names(missing))
        .when(any_non_array, _joined_names(non_array))
    )
    return reason, fields.cast("string")


def _with_cities(df: DataFrame, cities: DataFrame, city_key: str) -> DataFrame:
    """Left join of the city dimension as ``_city_*`` columns; Spark chooses the
    join by the dimension's measured size."""
    dim = cities.select(*[F.col(c).alias(f"_city_{c}") for c in CITY_COLUMNS])
    return df.join(dim, df[city_key] == dim["_city_city_id"], "left")


def validate_responses(
    df: DataFrame, json_col: str = "response_json", cities: DataFrame | None = None, city_key: str = "city_id"
) -> DataFrame:
    """Add ``reject_reason`` (NULL = valid) and ``reject_fields`` (the offending
    fields for rules 3 and 4) (I3a-I3e). ``cities`` adds rule 7."""
    reason, fields = _verdict()
    staged = _parsed_once(df, json_col)
    if cities is not None:
        staged = _with_cities(staged, cities, city_key)
        reason = F.coalesce(reason, F.when(F.col("_city_city_id").isNull(), F.lit("unknown_city")))
    return staged.select(*df.columns, reason.alias("reject_reason"), fields.alias("reject_fields"))


def _element(field: str, value: Column) -> Column:
    """One array element as the event's type. An element of another JSON type
    is NULL for its hour only, the way Bronze reads a mistyped field: a number
    with a fraction or a quoted number is no integer. NaN and the infinities are
    numbers, so a measure keeps them."""
    kind = F.schema_of_variant(value)
    if field == "time":
        return F.try_variant_get(value, "$", "string")
    if field == "european_aqi":
        return F.when(kind == "BIGINT", F.try_variant_get(value, "$", "int"))
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(number, F.try_variant_get(value, "$", "double"))


def flatten_hourly(
    responses: DataFrame,
    cities: DataFrame,
    json_col: str = "response_json",
    ingestion_col: str = "ingestion_timestamp_utc",
    city_key: str = "city_id",
) -> DataFrame:
    """Valid responses -> one event row per hourly entry.

    Element ``i`` of every array becomes row ``i``; the city's attributes are
    joined from ``cities`` (city_id, city, country, latitude, longitude);
    ``source`` is the API name. Invalid responses are skipped (see
    :func:`validate_responses` for the reasons; pass it ``cities`` to see unknown ones).
    If ``ingestion_col`` is absent, the ingestion time is the query's
    ``current_timestamp()`` in UTC.
    """
    reason, _ = _verdict()
    ingestion = (
        F.col(ingestion_col)
        if ingestion_col in responses.columns
        else iso_utc_text(to_utc_wallclock(F.current_timestamp()))
    )
    valid = _parsed_once(responses, json_col).where(reason.isNull()).select(
        F.col(city_key).alias("_city"), ingestion.alias("ingestion_timestamp_utc"), F.col("_h")
    )
    # join one row per response (before the explode) with the dimension
    joined = _with_cities(valid, cities, "_city").where(F.col("_city_city_id").isNotNull())
    arrays = [
        F.transform(_field(F.col("_h"), name, "array<variant>"), partial(_element, name)).alias(
            "measurement_timestamp" if name == "time" else name
        )
        for name in ("time", *MEASURES)
    ]
    rows = joined.select(
        *[F.col(f"_city_{c}").alias(c) for c in CITY_COLUMNS],
        "ingestion_timestamp_utc",
        F.inline(F.arrays_zip(*arrays)),
    ).withColumn("source", F.lit(SOURCE_NAME))
    return rows.select(*EVENT_COLUMNS)
