"""Expressions over the raw text of feature documents."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FEATURE_ENTRY_TEXT, REQUIRED_KEYS


def is_text(text: Column, lines: bool) -> Column:
    """Whether there is anything to parse. A blank line is nothing, and so is an empty
    file: a compressed one would be read as an empty text, a plain one as none."""
    return text.rlike(r"\S") if lines else text != ""


def is_object(text: Column) -> Column:
    return text.startswith("{") | text.rlike(r"^\s*\{")


def is_array(text: Column) -> Column:
    return text.startswith("[") | text.rlike(r"^\s*\[")


def in_brackets(text: Column) -> Column:
    """``text`` as the only element of an array. Parsed like this, anything
    after the end of a document is an error; as it is, it would be ignored."""
    return F.concat(F.lit("["), text, F.lit("]"))


def parse_entries(text: Column, entry: T.StructType, mode: str) -> Column:
    """Entries of a document; a lone object counts as an array of one. Null if
    the text is neither."""

    def parsed(ddl: str) -> Column:
        return F.from_json(in_brackets(text), ddl, {"mode": mode})

    one = entry.simpleString()
    return F.when(is_object(text), parsed(f"array<{one}>")).when(
        is_array(text), F.get(parsed(f"array<array<{one}>>"), F.lit(0))
    )


def first_entry(entries: Column) -> Column:
    return F.get(entries, F.lit(0))


def not_a_document(entries: Column) -> Column:
    """No entries could be parsed, or the first one is a bare null."""
    return entries.isNull() | ((F.size(entries) > 0) & first_entry(entries).isNull())


def _no_measure_is_null(entry: Column) -> Column:
    return reduce(operator.and_, (entry[k].isNotNull() for k in REQUIRED_KEYS))


def has_wrong_types(text: Column, entries: Column) -> Column:
    """Whether a measure is there but is not a number, so that lenient parsing
    made it null. Only documents with nulls are parsed as text to find out."""
    as_text = parse_entries(text, FEATURE_ENTRY_TEXT, "PERMISSIVE")
    lost = F.zip_with(
        entries,
        as_text,
        lambda number, raw: reduce(
            operator.or_, (number[k].isNull() & raw[k].isNotNull() for k in REQUIRED_KEYS)
        ),
    )
    clean = (F.size(entries) == 1) & _no_measure_is_null(first_entry(entries))
    return F.when(clean, False).otherwise(F.exists(lost, lambda one: one))


def has_unfit_duration(entries: Column) -> Column:
    """Whether a duration is a number that no long stands for: infinite, out of
    range, or with a fraction. NaN is a missing value and fits."""

    def unfit(entry: Column) -> Column:
        number = entry["duration_ms"]
        off = (number % 1 != 0) | (F.abs(number) >= float(1 << 63))
        return F.coalesce(off & ~F.isnan(number), F.lit(False))

    return F.coalesce(F.exists(entries, unfit), F.lit(False))


def has_required_keys(text: Column, entries: Column) -> Column:
    """Whether the first entry carries every required key, nulls included.

    Parsed entries cannot tell a null value from an absent key. If none of the
    values is null, all keys are there and that settles it; only the few
    documents with a null go back to the text to look at the key names.
    """
    first_text = F.when(is_object(text), text).otherwise(F.get_json_object(text, "$[0]"))
    missing = F.array_except(
        F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.json_object_keys(first_text)
    )
    return (F.size(entries) > 0) & (
        _no_measure_is_null(first_entry(entries)) | (F.size(missing) == 0)
    )
