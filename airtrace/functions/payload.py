"""Typed access into raw JSON payloads held as VARIANT.

The payload is parsed once into a VARIANT; every field is then a path lookup
with a type gate, so one odd value only voids that value (never the row or
the whole pollutant map) and nothing leaves the JVM.

Type gates reproduce what a typed JSON scan of the curated text would give:
INT fields take only JSON integers in range (``16.0``, ``"16"`` and ``true``
become NULL); DOUBLE fields take JSON numbers and the non-numeric number
texts; pollutant values take numbers and booleans, as a dynamic language's
``isinstance(v, (int, float))`` test does.

The field builders return Spark SQL expression text (wrapped by ``F.expr``
in the Column-returning functions): one expression per field is analysed in
a single call instead of dozens of small Column calls from Python.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from airtrace.schemas import WEATHER_KEYS

# --- fixed values -----------------------------------------------------------
# Variant type names (``schema_of_variant``) accepted for each target type.
_INT_TYPES = "^BIGINT$"
_NUMBER_TYPES = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
_POLLUTANT_TYPES = "^(BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL)"
# Texts a typed JSON scan reads into a DOUBLE field as non-finite numbers.
_NAN_TEXTS = ("NaN",)
_POS_INF_TEXTS = ("Infinity", "+Infinity", "+INF")
_NEG_INF_TEXTS = ("-Infinity", "-INF")
# ---------------------------------------------------------------------------


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(values: tuple[str, ...]) -> str:
    return ", ".join(_text(v) for v in values)


#: Closing element of the array a message is wrapped in; drawn anew in each
#: driver process, so no message can hold it.
_SENTINEL = f"end-{uuid.uuid4().hex}"


def parse_wrapped(value: Column | str) -> Column:
    """The message text parsed as the first of two elements of a JSON array."""
    text = F.col(value) if isinstance(value, str) else value
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_SENTINEL}"]')))


def single_value(wrapped: Column) -> Column:
    """The first element of a parsed ``[message, sentinel]`` array, if strict.

    The parser stops at the end of the first value, so ``{"a":1} x`` alone
    and ``{"a":1}] x`` inside brackets would pass.  A message is one JSON
    value only when the sentinel follows it as the second and last element;
    a bracket or comma of the message itself moves or cuts off the sentinel.
    Scalars, arrays and ``null`` are valid JSON and stay valid (``null``
    gives a VARIANT null, not SQL NULL).
    """
    first = F.try_variant_get(wrapped, "$[0]", "variant")
    second = F.try_variant_get(wrapped, "$[1]", "string")
    third = F.try_variant_get(wrapped, "$[2]", "variant")
    return F.when(first.isNotNull() & (second == _SENTINEL) & third.isNull(), first)


# --- SQL text builders ---------------------------------------------------------

def node_sql(payload: str, path: str) -> str:
    return f"try_variant_get({payload}, {_text(path)}, 'variant')"


def int_sql(payload: str, path: str) -> str:
    node = node_sql(payload, path)
    return (
        f"CASE WHEN regexp_like(schema_of_variant({node}), {_text(_INT_TYPES)}) "
        f"THEN try_variant_get({node}, '$', 'int') END"
    )


def double_sql(payload: str, path: str) -> str:
    node = node_sql(payload, path)
    kind = f"schema_of_variant({node})"
    text = f"try_variant_get({node}, '$', 'string')"
    return (
        f"CASE WHEN regexp_like({kind}, {_text(_NUMBER_TYPES)}) "
        f"THEN try_variant_get({node}, '$', 'double') "
        f"WHEN {kind} = 'STRING' AND {text} IN ({_in(_NAN_TEXTS)}) THEN double('NaN') "
        f"WHEN {kind} = 'STRING' AND {text} IN ({_in(_POS_INF_TEXTS)}) THEN double('Infinity') "
        f"WHEN {kind} = 'STRING' AND {text} IN ({_in(_NEG_INF_TEXTS)}) THEN double('-Infinity') "
        f"END"
    )


def string_sql(payload: str, path: str) -> str:
    return f"try_variant_get({payload}, {_text(path)}, 'string')"


def pollutant_map_sql(payload: str) -> str:
    iaqi = f"try_variant_get({payload}, '$.data.iaqi', 'map<string,variant>')"
    gate = (
        f"coalesce(regexp_like(schema_of_variant(try_variant_get(e, '$.v', 'variant')), "
        f"{_text(_POLLUTANT_TYPES)}), false)"
    )
    kept = f"map_filter({iaqi}, (k, e) -> NOT k IN ({_in(WEATHER_KEYS)}) AND {gate})"
    values = f"transform_values({kept}, (k, e) -> try_variant_get(e, '$.v', 'double'))"
    ordered = f"map_from_entries(array_sort(map_entries({values})))"
    return f"coalesce({ordered}, cast(map() AS map<string,double>))"


def day_sql(payload: str, fallback_sql: str) -> str:
    node = node_sql(payload, "$.data.time.iso")
    text = f"try_variant_get({node}, '$', 'string')"
    return (
        f"CASE WHEN schema_of_variant({node}) = 'STRING' AND length({text}) >= 10 "
        f"THEN substring({text}, 1, 10) ELSE {fallback_sql} END"
    )


# --- Column functions -------------------------------------------------------------

def payload_int(payload: str, path: str) -> Column:
    """INT at ``path`` when it is a JSON integer in range, else NULL."""
    return F.expr(int_sql(_ident(payload), path))


def payload_double(payload: str, path: str) -> Column:
    """DOUBLE at ``path`` when it is a JSON number (not a boolean), else NULL."""
    return F.expr(double_sql(_ident(payload), path))


def payload_string(payload: str, path: str) -> Column:
    """Text at ``path``: strings as is, other non-null JSON as its JSON text."""
    return F.expr(string_sql(_ident(payload), path))


def geo_value(payload: str, index: int) -> Column:
    """Element ``index`` of ``data.city.geo`` as DOUBLE (C4).

    Not an array, too short, or not a number -> NULL.
    """
    return payload_double(payload, f"$.data.city.geo[{int(index)}]")


def station_key(payload: str) -> Column:
    """Untyped station id as text: ``42`` and ``"42"`` give the same key."""
    return payload_string(payload, "$.data.idx")


def pollutant_map(payload: str) -> Column:
    """Pollutant readings of ``data.iaqi`` as ``MAP<STRING, DOUBLE>``.

    Every ``iaqi`` key except the weather keys counts.  An entry is kept only
    when its ``v`` is a number or a boolean (``true`` -> 1.0); strings, nulls
    and non-object entries are dropped one by one.  Keys are sorted.  A
    missing or non-object ``iaqi`` gives an empty map, never NULL.
    """
    return F.expr(pollutant_map_sql(_ident(payload)))


def day_key(payload: str, fallback_day: str | None = None) -> Column:
    """Storage day of a payload.

    The first ten characters of ``data.time.iso`` when it is a text of at
    least ten characters (taken verbatim, not validated); otherwise the
    fallback processing date (default: the current date).
    """
    fallback = "CAST(current_date() AS STRING)" if fallback_day is None else _text(fallback_day)
    return F.expr(day_sql(_ident(payload), fallback))
