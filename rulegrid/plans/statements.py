"""The two statements as named, parameterised functions with one result schema.

``run_statement("in_list_group_sum", table_b=df, list=[...])`` mirrors calling
a named statement with bound parameters.  The ``list`` parameter is a
collection of objects; each IN list plucks one property from every element
(``inv_item_id`` for the items, ``sch_org_id`` for the orgs).  Elements may be
mappings, ``Row``s or objects with attributes.  For key lists that are
themselves large data, pass a DataFrame instead; it is never collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame

from rulegrid.operators.keyed_sums import (
    DEFAULT_ORG_CONSTANT,
    RESULT_COLUMNS,
    in_keys_group_sum,
    in_list_group_sum,
    join_group_sum,
)


def pluck(elements: Iterable[Any], prop: str) -> list:
    """One property of every element, in order (duplicates kept, as in the bound list)."""
    out = []
    for element in elements:
        if isinstance(element, dict):
            out.append(element.get(prop))
        elif hasattr(element, "asDict"):
            out.append(element.asDict().get(prop))
        else:
            out.append(getattr(element, prop, None))
    return out


def in_list_statement(
    table_b: DataFrame, list: Iterable[Any] | DataFrame, org_constant: str = DEFAULT_ORG_CONSTANT
) -> DataFrame:
    if isinstance(list, DataFrame):
        return in_keys_group_sum(table_b, list, org_constant=org_constant)
    elements = [*list]
    return in_list_group_sum(
        table_b, pluck(elements, "inv_item_id"), pluck(elements, "sch_org_id"), org_constant
    )


def join_statement(table_a: DataFrame, table_b: DataFrame) -> DataFrame:
    return join_group_sum(table_a, table_b)


STATEMENTS: dict[str, Callable[..., DataFrame]] = {
    "join_group_sum": join_statement,
    "in_list_group_sum": in_list_statement,
}


def run_statement(name: str, **params: Any) -> DataFrame:
    """Run a named statement; every statement returns :data:`RESULT_COLUMNS`."""
    try:
        statement = STATEMENTS[name]
    except KeyError:
        raise ValueError(f"unknown statement {name!r}; known: {', '.join(STATEMENTS)}") from None
    result = statement(**params)
    assert tuple(result.columns) == RESULT_COLUMNS, result.columns
    return result
