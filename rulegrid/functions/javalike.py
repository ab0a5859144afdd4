"""Spark SQL functions with the semantics of the JDK string calls rules use.

Rules are Spark SQL expression text, so these helpers are SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN``), not Python UDFs: Catalyst inlines
the body at every call site and the projection stays in whole-stage codegen.
Each helper returns null where the JDK call would throw, which is how a rule
"fails on one row" without stopping the job.

* ``split_at(s, rx, k)`` is ``s.split(rx)[k]``.  ``String.split`` drops trailing
  empty strings and returns ``[s]`` when ``rx`` never matches; Spark's
  ``split`` keeps trailing empties.  Element ``k`` of the Java array exists
  iff the Spark array (limit -1) has one element and ``k = 0``, or some
  element at ``k`` or later is non-empty.  Same regex dialect (java.util.regex)
  on both sides, so this holds for any pattern, not only fixed delimiters.
* ``substr_strict(s, b, e)`` is ``s.substring(b, e)``: 0-based, end exclusive,
  null where Java throws (``b < 0``, ``b > e``, ``e > length``).
* ``parse_int`` / ``parse_long`` are ``Integer.parseInt`` / ``Long.parseLong``:
  optional sign and ASCII digits only (no blanks), null on overflow.

Characters are counted in code points where the JDK counts UTF-16 units; the
two differ only for characters outside the Basic Multilingual Plane.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Raw strings: the SQL text itself carries the backslash escapes ('\\z').
_DEFINITIONS = {
    # The array is referenced only in the first WHEN, so common-subexpression
    # elimination computes split(...) once per row; the THEN reuses it.
    "split_at": r"""
CREATE OR REPLACE TEMPORARY FUNCTION split_at(s STRING, rx STRING, k INT)
RETURNS STRING
RETURN CASE
  WHEN k >= 0 AND (size(split(s, rx, -1)) = 1
                   OR array_join(slice(split(s, rx, -1), k + 1, size(split(s, rx, -1))), '') <> '')
    THEN get(split(s, rx, -1), k)
END""",
    "substr_strict": r"""
CREATE OR REPLACE TEMPORARY FUNCTION substr_strict(s STRING, b INT, e INT)
RETURNS STRING
RETURN CASE
  WHEN b >= 0 AND b <= e AND e <= char_length(s) THEN substring(s, b + 1, e - b)
END""",
    # At most 10 significant digits always fit a BIGINT, so the cast never
    # overflows; the range test then decides. (A failing 32-bit cast costs ~7x more.)
    "parse_int": r"""
CREATE OR REPLACE TEMPORARY FUNCTION parse_int(s STRING)
RETURNS INT
RETURN CASE
  WHEN s RLIKE '^[+-]?0*[0-9]{1,10}\\z'
       AND try_cast(s AS BIGINT) BETWEEN -2147483648 AND 2147483647
    THEN cast(try_cast(s AS BIGINT) AS INT)
END""",
    "parse_long": r"""
CREATE OR REPLACE TEMPORARY FUNCTION parse_long(s STRING)
RETURNS BIGINT
RETURN CASE WHEN s RLIKE '^[+-]?[0-9]+\\z' THEN try_cast(s AS BIGINT) END""",
}

FUNCTION_NAMES = tuple(_DEFINITIONS)


_REGISTERED: set[str] = set()


def register_functions(spark: SparkSession) -> None:
    """Register the helpers in ``spark``'s session catalog, once per session.

    Temporary functions belong to one session; ``CREATE OR REPLACE`` would
    also be safe to repeat.  Only the driver-side catalog changes; no job runs.
    """
    try:
        session_id = spark._jsparkSession.sessionUUID()
    except AttributeError:  # not a classic session: register every time
        session_id = None
    if session_id in _REGISTERED and spark.catalog.functionExists(FUNCTION_NAMES[0]):
        return
    for ddl in _DEFINITIONS.values():
        spark.sql(ddl)
    if session_id is not None:
        _REGISTERED.add(session_id)


def _call(name: str, *args: Column) -> Column:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active SparkSession")
    register_functions(spark)
    return F.call_function(name, *args)


def _as_col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def split_at(s: Column | str, rx: str, k: int) -> Column:
    """Column form of ``split_at`` for DataFrame-API users."""
    return _call("split_at", _as_col(s), F.lit(rx), F.lit(k))


def substr_strict(s: Column | str, begin: int, end: int) -> Column:
    return _call("substr_strict", _as_col(s), F.lit(begin), F.lit(end))


def parse_int(s: Column | str) -> Column:
    return _call("parse_int", _as_col(s))


def parse_long(s: Column | str) -> Column:
    return _call("parse_long", _as_col(s))
