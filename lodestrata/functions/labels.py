"""Codes, labels and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

from lodestrata.functions.numeric import as_column


def _literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode(code: Column | str, labels: Mapping[int, str]) -> Column:
    """Label of a code; unknown codes give null."""
    return _literal_map(labels)[as_column(code)]


def crosswalk(text: Column | str, codes: Mapping[str, int]) -> Column:
    """Code of a text label, ignoring case and surrounding blanks."""
    return _literal_map(codes)[F.lower(F.trim(as_column(text)))]


def ladder(value: Column | str, steps: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first step whose upper limit exceeds ``value``; ``top`` above all of them.

    A null value has no band.
    """
    value = as_column(value)
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in steps:
        label = label.when(value < F.lit(limit), F.lit(name))
    return label.otherwise(F.lit(top))


def interval_label(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals between consecutive edges, the lowest edge included.

    Values outside the edges get null.
    """
    value = as_column(value)
    label = F.when(value < F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels, strict=True):
        label = label.when(value <= F.lit(upper), F.lit(name))
    return label


def text_flag(text: Column | str, words: Mapping[str, bool], fallback: Column) -> Column:
    """Boolean spelled as text; unrecognised words use ``fallback`` (null counts as false)."""
    return F.coalesce(_literal_map(words)[F.lower(F.trim(as_column(text)))], fallback, F.lit(False))


def trend(first: Column, last: Column, first_cycle: Column, last_cycle: Column,
          dead_band: float, names: Mapping[str, str]) -> Column:
    """Direction of change between two cycles with a dead band around zero."""
    change = last - first
    return (
        F.when(first_cycle == last_cycle, F.lit(names["single"]))
        .when(change > F.lit(dead_band), F.lit(names["up"]))
        .when(change < F.lit(-dead_band), F.lit(names["down"]))
        .otherwise(F.lit(names["flat"]))
    )
