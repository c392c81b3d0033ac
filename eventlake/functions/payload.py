"""Access to the payload, a variant: nothing here parses text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.schema import LABELS_TYPE, PULL_REQUEST


def labels(payload: str | Column = "payload") -> Column:
    """Label array of any event; only name and colour are decoded."""
    return F.try_variant_get(_column(payload), "$.labels", LABELS_TYPE)


def pr_labels(
    type_col: str | Column = "type", payload: str | Column = "payload"
) -> Column:
    """Label array of pull requests; NULL for every other type.

    Issues carry a field of the same name, which must not show up as a pull
    request label. The branch is lazy, so other payloads are never looked into.
    """
    kind = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.when(kind == PULL_REQUEST, labels(payload))


def keys(payload: str | Column = "payload") -> Column:
    """Top-level field names, NULL for what is not an object."""
    return F.map_keys(F.try_variant_get(_column(payload), "$", "map<string,variant>"))


def key_seen(keys_col: str, name: str) -> Column:
    """Aggregate: whether any row has the named field."""
    return F.coalesce(F.max(F.array_contains(keys_col, name)), F.lit(False))


def fields(names: Sequence[str], payload: str | Column = "payload") -> Column:
    """Struct of the named fields as text; absent and JSON null are NULL."""
    return _each(names, payload, "string")


def arrays(names: Sequence[str], payload: str | Column = "payload") -> Column:
    """Struct of the named array fields; elements stay variants, whatever their shape."""
    return _each(names, payload, "array<variant>")


def _each(names: Sequence[str], payload: str | Column, kind: str) -> Column:
    return F.struct(*(F.try_variant_get(_column(payload), f"$['{n}']", kind).alias(n) for n in names))


def _column(payload: str | Column) -> Column:
    return F.col(payload) if isinstance(payload, str) else payload
