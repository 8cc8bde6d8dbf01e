"""From feature documents to the audio-features table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.documents import (
    has_required_keys,
    has_unfit_duration,
    has_wrong_types,
    not_a_document,
    parse_entries,
)
from ..schemas import FEATURE_ENTRY, REQUIRED_KEYS
from .tracks import outcome

# The tests on ``entries`` below sit inside the generator and not in a filter.
# A filter would be pushed below the projection and parse every document again.


def _parsed(documents: DataFrame, mode: str) -> DataFrame:
    text = F.col("value")
    return documents.select(text, parse_entries(text, FEATURE_ENTRY, mode).alias("entries"))


def _rejected() -> Column:
    text, entries = F.col("value"), F.col("entries")
    return (
        not_a_document(entries) | has_wrong_types(text, entries) | has_unfit_duration(entries)
    )


def _feature_columns(entry: Column) -> list[Column]:
    def measure(key: str) -> Column:
        # NaN would be above every threshold; it stands for a missing value.
        number = F.nanvl(entry[key], F.lit(None))
        return (number.try_cast("bigint") if key == "duration_ms" else number).alias(key)

    return [entry["id"].alias("track_id"), *[measure(k) for k in REQUIRED_KEYS]]


def feature_rows(documents: DataFrame, *, malformed: str = "fail") -> DataFrame:
    """The eleven feature columns, one row per entry of each accepted document.

    A document is accepted if its first entry has all required keys; this drops
    error bodies. Later entries may lack keys and then give nulls, as does a NaN;
    an empty array and a null among the entries give nothing.

    A text that is not such JSON, or has something other than a number for a
    measure, or other than a whole number of 64 bits for the duration, fails the job. With ``malformed="skip"`` it gives no rows, and
    ``rejected_documents`` shows it.
    """
    if malformed not in ("fail", "skip"):
        raise ValueError(f"malformed must be fail or skip, not {malformed!r}")
    text, entries = F.col("value"), F.col("entries")
    accepted = F.when(has_required_keys(text, entries), entries)
    if malformed == "fail":
        failure = F.raise_error("not a feature document; rejected_documents() finds it")
        unfit = not_a_document(entries) | has_unfit_duration(entries)
        accepted = F.when(unfit, failure).otherwise(accepted)
    else:
        accepted = F.when(~_rejected(), accepted)

    return (
        _parsed(documents, "FAILFAST" if malformed == "fail" else "PERMISSIVE")
        .select(F.explode(accepted).alias("entry"))
        .where(F.col("entry").isNotNull())
        .select(*_feature_columns(F.col("entry")))
    )


def rejected_documents(documents: DataFrame) -> DataFrame:
    """The texts that ``feature_rows(malformed="skip")`` passes over."""
    return _parsed(documents, "PERMISSIVE").select(
        F.explode(F.when(_rejected(), F.array("value"))).alias("value")
    )


def feature_outcomes(documents: DataFrame) -> DataFrame:
    """What ``feature_rows(malformed="skip")`` and ``rejected_documents`` give, in one
    pass: ``outcome`` is ``row`` or ``rejected``, ``value`` the text of a rejected
    document; the columns of the other kind are null."""
    text, entries = F.col("value"), F.col("entries")
    nothing = F.lit(None).cast(FEATURE_ENTRY)
    rejected = F.array(outcome("rejected", _feature_columns(nothing), text))
    rows = F.transform(
        F.filter(entries, lambda entry: entry.isNotNull()),
        lambda entry: outcome("row", _feature_columns(entry)),
    )
    one = F.explode(F.when(_rejected(), rejected).when(has_required_keys(text, entries), rows))
    return _parsed(documents, "PERMISSIVE").select(one.alias("one")).select("one.*")
