"""Pruned extracts of micro-data and their normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.casts import conform_types
from lodestrata.functions.labels import crosswalk, text_flag
from lodestrata.operators.keys import sample_per_group


def pruned_extract(df: DataFrame, columns: Sequence[str], cycle: str, cycles: Sequence[int],
                   sample: int | None = None, group: Sequence[str] = (), key: Sequence[str] = ()) -> DataFrame:
    """Named columns of the chosen cycles; optionally a seeded sample per group.

    Both restrictions reach the file scan as projection and pushed filter.
    """
    picked = df.where(F.col(cycle).isin(list(cycles))).select(*columns)
    return sample_per_group(picked, group, key, sample) if sample else picked


def code_dictionary(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order)


def column_codes(dictionary: DataFrame, column_field: str, column: str, key: str, value: str) -> DataFrame:
    """Distinct key and value pairs documented for one column."""
    return dictionary.where(F.col(column_field) == column).select(key, value).distinct()


def normalise_extract(df: DataFrame, numeric: Mapping[str, str], renames: Mapping[str, str],
                      segment: str, segment_codes: Mapping[str, int], flag: str,
                      flag_words: Mapping[str, bool], score: str, cut: float,
                      keep: Sequence[str]) -> DataFrame:
    """Make an extract conform: numbers, segment code, pass flag, known columns.

    Bad numbers become null; the segment's text is kept as ``<segment>_text``; a
    flag word that is not recognised falls back to ``score >= cut``; columns of
    ``keep`` that the extract lacks are skipped.
    """
    typed = conform_types(df.withColumnsRenamed(dict(renames)), numeric)
    done = typed.withColumns({
        f"{segment}_text": F.col(segment),
        segment: crosswalk(F.col(segment).cast("string"), segment_codes),
        flag: text_flag(F.col(flag).cast("string"), flag_words, F.col(score) >= F.lit(cut)),
    })
    return done.select(*[c for c in keep if c in done.columns])
