"""Parsing, checking and encoding of JSON readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gearwatch.functions.numbers import INTEGER_TEXT, doubles_sql, quoted
from gearwatch.schema import CYCLE, ENGINE, NATURAL_KEY, READINGS, SOURCE, TEXT_COLUMNS

_TEXTS = ", ".join(f"{c} STRING" for c in [SOURCE, "source", *TEXT_COLUMNS])
_NUMBERS = ", ".join(f"{c} DOUBLE" for c in [SOURCE, "source", *TEXT_COLUMNS])
# Every reading of a message is absent or a finite JSON number.
_PLAIN = " AND ".join(f"(_text.{c} IS NULL OR (_number.{c} IS NOT NULL AND abs(_number.{c}) <= 1.7976931348623157E308D))" for c in READINGS)


def _json(name: str) -> str:
    """JSON text of a field, to tell the text "true" from the value true."""
    return f"to_json(try_variant_get(_doc, '$.{name}', 'variant'))"


def _key_number(name: str) -> str:
    """Whole number of a key field: numbers are cut, digit texts read, true is 1, others null."""
    text = f"trim(_text.{name})"
    return (f"CASE WHEN _number.{name} IS NOT NULL THEN try_cast(_number.{name} AS INT) "
            f"WHEN {text} RLIKE '{INTEGER_TEXT}' THEN try_cast({text} AS INT) "
            f"WHEN {text} IN ('true', 'false') THEN CASE {_json(name)} WHEN 'true' THEN 1 WHEN 'false' THEN 0 END END")


def _source_field(name: str) -> str:
    """Text of a source field; empty, zero, false and empty containers count as missing."""
    text = f"_text.{name}"
    return (f"CASE WHEN {text} = '' OR _number.{name} = 0 THEN NULL "
            f"WHEN {text} IN ('true', 'false', '[]', '{{}}') THEN CASE {_json(name)} WHEN 'true' THEN 'True' "
            f"WHEN 'false' THEN NULL WHEN '[]' THEN NULL WHEN '{{}}' THEN NULL ELSE {text} END ELSE {text} END")


def _computed_once(df: DataFrame, keep: list[str], columns: dict[str, str]) -> DataFrame:
    """Add columns as a generated one-row array, so filters above do not copy their expressions down."""
    fields = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return df.selectExpr(*keep, f"inline(array(named_struct({fields})))")


def parse_messages(df: DataFrame, body: str = "body", default_source: str = "UNKNOWN") -> DataFrame:
    """Typed reading and ``reject_reason`` per message; other columns are kept.

    Reasons, in order of checking: bad_json, not_object, bad_engine, bad_cycle, bad_sensor. A strict
    parse decides whether a message is JSON, one pass takes the texts of all fields, one the numbers.
    Readings are taken as they are typed; only messages with a reading that is no finite number
    have the texts of their readings examined.
    """
    keep = df.columns
    docs = df.selectExpr(*keep, f"try_parse_json({body}) AS _doc", f"from_json({body}, '{_TEXTS}') AS _text",
                         f"from_json({body}, '{_NUMBERS}') AS _number")
    typed = _computed_once(docs, keep, {
        "_is_json": "_doc IS NOT NULL", "_is_object": f"trim('\\t\\n\\r ' FROM {body}) LIKE '{{%'",
        SOURCE: f"coalesce({_source_field(SOURCE)}, {_source_field('source')}, {quoted(default_source)})",
        ENGINE: _key_number(ENGINE), CYCLE: _key_number(CYCLE),
        "_texts": f"array({', '.join(f'_text.{c}' for c in READINGS)})",
        "_plain": _PLAIN,
        "_values": f"CASE WHEN {_PLAIN} THEN array({', '.join(f'_number.{c}' for c in READINGS)}) ELSE {doubles_sql([f'_text.{c}' for c in READINGS])} END"})
    reason = (f"CASE WHEN NOT _is_json THEN 'bad_json' WHEN NOT _is_object THEN 'not_object' "
              f"WHEN {ENGINE} IS NULL THEN 'bad_engine' WHEN {CYCLE} IS NULL THEN 'bad_cycle' "
              "WHEN NOT _plain AND exists(arrays_zip(_texts, _values), r -> r._texts IS NOT NULL AND r._values IS NULL) THEN 'bad_sensor' "
              "END AS reject_reason")
    values = [f"_values[{i}] AS {c}" for i, c in enumerate(READINGS)]
    return typed.selectExpr(*keep, SOURCE, ENGINE, CYCLE, *values, reason)


def accepted(parsed: DataFrame, body: str = "body") -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", body)


def rejected(parsed: DataFrame, body: str = "body") -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("arrival_seq", body, "reject_reason")


def encode_messages(df: DataFrame, dataset: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Message key ``source:engine:cycle`` and JSON body; NaN and null are written as null.

    ``dataset`` names the source of every row; without it ``source_file`` is used. ``keep``
    columns stay beside the message.
    """
    keep = keep or []
    source = quoted(dataset.upper()) if dataset else SOURCE
    known = set(df.columns)
    fields = []
    for c in TEXT_COLUMNS:
        if c not in known:
            fields.append(f"CAST(NULL AS DOUBLE) AS {c}")
        elif c in READINGS:
            fields.append(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}")
        else:
            fields.append(c)
    rows = df.selectExpr(*keep, *fields, f"{source} AS source", f"{source} AS {SOURCE}")
    body = [c for c in rows.columns if c not in keep]
    return rows.select(*keep, F.concat_ws(":", *NATURAL_KEY).alias("key"),
                       F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"))
