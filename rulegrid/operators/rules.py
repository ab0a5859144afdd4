"""Apply a set of rules (Spark SQL expressions) to every record of a table.

A rule is expression text over the table's columns, e.g.
``split_at(text1, ':', 1) || '.step'``.  All rules of a set are compiled once
on the driver and evaluated as *one* narrow projection on the executors: no
shuffle, no Python per row, whole-stage codegen.

Failure is null, at two levels:

* a rule that does not compile (syntax, unknown column, wrong types, a bad
  constant pattern, aggregates, generators or window functions, which are not
  row-wise) is reported by :func:`check_rules` and evaluates to a typed null column;
* a rule that fails on one record gives null there, whatever raised: each rule that may raise is evaluated inside the
  null-on-error expression of Spark's ``try_*`` functions (:mod:`rulegrid.operators.attempts`).  Rules are analysed without ANSI
  mode, in a session of their own, so casts and division by zero give null and integer ``+ - *`` wrap as in the JVM.

:func:`rules_reasons` tells failures from nulls that a rule means to give, with a reason for each.  :func:`rules_failures`
only counts nulls.  A Python UDF inside a rule runs outside of the JVM's expressions, so its errors are not caught.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, VariantType

from rulegrid.functions import register_functions
from rulegrid.operators.attempts import NOT_COMPILED, Reasons, back, bad_pattern, forgiving, lenient, parse, strict

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RuleProblem:
    rule_id: str
    expression: str
    message: str


@dataclass(frozen=True)
class RuleProjection:
    frame: DataFrame  # keys (if any) + one typed column per rule, in rule order
    types: dict[str, DataType]
    problems: tuple[RuleProblem, ...]
    own: tuple[str, ...] = ()  # the rules' columns while they are not named by rule id

    @property
    def rule_ids(self) -> list[str]:
        return list(self.types)


def _project(df: DataFrame, keys: Sequence[str], texts: list[Column | str], also: Sequence[str] = (), precise: bool = False, variant: bool = False) -> DataFrame:
    """``keys`` + one struct per rule, holding the rule's value in field ``v``.

    A rule inside a struct next to a real column cannot be an aggregate or a
    generator (Spark rejects both there); window functions are looked for in the
    analysed plan, so only row-wise expressions pass.
    The struct costs nothing at run time: Catalyst folds ``struct(x).v`` to ``x``.
    ``also``: columns passed through under names of their own.
    """
    anchor = [F.col(_quoted(k)) for k in keys] or [F.col(_quoted(df.columns[0]))]
    wrapped = [F.struct((forgiving(df, t, precise, variant) if isinstance(t, str) else t).alias("v")).alias(f"{_prefix(df)}rule{i}") for i, t in enumerate(texts)]
    out = df.select(*anchor, *(F.col(_quoted(c)).alias(f"{_prefix(df)}var{i}") for i, c in enumerate(also)), *wrapped)
    if re.search(r"^[\s:+|-]*Window \[", out._jdf.queryExecution().analyzed().toString(), re.M):
        raise AnalysisException("window functions are not row-wise rules")
    return out


def _prefix(df: DataFrame) -> str:
    """What no column of ``df`` starts with: the start of helper columns' names."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _compiled(
    df: DataFrame, rules: Mapping[str, str], keys: Sequence[str], fallback_types: Mapping[str, DataType] | None, also: Sequence[str] = (), precise: bool = False,
    variant: bool = False,
) -> RuleProjection:
    """``keys`` + one column per rule in rule order, by names that no key or rule id can equal or break."""
    spark = df.sparkSession
    register_functions(spark)
    own = lenient(df)
    fallback_types = dict(fallback_types or {})
    problems: list[RuleProblem] = []
    texts: list[Column | str] = []

    def compiled(rule_id: str, text: str, alone: bool) -> Column | str:
        try:
            message = bad_pattern(spark, parse(spark, text))
            if not message and alone:
                _project(own, keys, [text], (), precise, variant)
        except PySparkException as exc:  # parse or analysis error
            message = str(exc).strip().splitlines()[0]
        if not message:
            return text
        problems.append(RuleProblem(rule_id, text, message))
        log.info("rule %s does not compile: %s", rule_id, message)
        return F.lit(None).cast(fallback_types.get(rule_id, StringType()))

    try:
        texts = [compiled(r, t, False) for r, t in rules.items()]
        wrapped = _project(own, keys, texts, also, precise, variant)
    except PySparkException:
        problems.clear()
        texts = [compiled(r, t, True) for r, t in rules.items()]
        wrapped = _project(own, keys, texts, also, precise, variant)
    wrapped = back(wrapped, df)
    names = tuple(f"{_prefix(df)}r{i}" for i in range(len(rules)))
    values = [F.col(f"{_prefix(df)}rule{i}.v").alias(n) for i, n in enumerate(names)]
    frame = wrapped.select(*[F.col(_quoted(k)) for k in keys], *[f"{_prefix(df)}var{i}" for i in range(len(also))], *values)
    types = {r: frame.schema[n].dataType for n, r in zip(names, rules)}
    return RuleProjection(frame, types, tuple(problems), names)


def project_rules(
    df: DataFrame,
    rules: Mapping[str, str],
    keys: Sequence[str] = (),
    fallback_types: Mapping[str, DataType] | None = None,
    precise: bool = False,
) -> RuleProjection:
    """Project every rule over ``df`` and report the rules that do not compile.

    All rules are analysed together (driver only, no job on the data); only when
    that fails is each rule analysed alone, to find the bad ones, which then become
    null columns of their ``fallback_types`` (string where none is given).
    Rule ids become column names, so they must differ from the keys and from each
    other the way the session compares names.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    names = [x if exact else x.lower() for x in (*keys, *rules)]
    clash = sorted({x for x in names if names.count(x) > 1})
    if clash:
        raise ValueError(f"rule ids and key columns clash: {clash}")
    found = _compiled(df, rules, keys, fallback_types, precise=precise)
    return RuleProjection(found.frame.toDF(*keys, *rules), found.types, found.problems)


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> list[RuleProblem]:
    """Rules that cannot be evaluated on ``df``, with the analyser's message."""
    return list(_compiled(df, rules, (), None).problems)


def rules_wide(
    df: DataFrame,
    rules: Mapping[str, str],
    keys: Sequence[str] = (),
    fallback_types: Mapping[str, DataType] | None = None,
    precise: bool = False,
) -> DataFrame:
    """``keys`` + one typed column per rule, one row per input row; ``precise``: with decimal arithmetic in every rule."""
    return project_rules(df, rules, keys, fallback_types, precise).frame


def _unpivoted(frame: DataFrame, rules: Mapping[str, str], keys: list[str], own: Sequence[str], result: str) -> DataFrame:
    """``(keys..., rule_id, result)``: the columns ``own`` of the rules as rows."""
    names = F.create_map(*[F.lit(x) for pair in zip(own, rules) for x in pair])
    label = f"{_prefix(frame)}rule"
    kept = [F.col(_quoted(k)) for k in keys]
    long = frame.unpivot([_quoted(k) for k in keys], list(own), label, result)
    return long.select(*kept, names[F.col(label)].alias("rule_id"), F.col(_quoted(result)))


def rules_long(
    df: DataFrame,
    rules: Mapping[str, str],
    keys: Sequence[str],
    result_col: str = "result",
    fallback_types: Mapping[str, DataType] | None = None,
) -> DataFrame:
    """``(keys..., rule_id, result)``: one row per input row and rule.

    Results of mixed types share one string column (``true``, ``128``,
    ``2.0000000000``); nulls are kept.  The unpivot is a narrow ``Expand``
    over the wide projection, so this is still one pass with no shuffle.  Rule
    ids are values here: any text will do.
    """
    found = _compiled(df, rules, keys, fallback_types)
    kept = [F.col(_quoted(k)) for k in keys]
    if not rules:
        empty = [F.lit(None).cast("string").alias("rule_id"), F.lit(None).cast("string").alias(result_col)]
        return found.frame.select(*kept, *empty).where(F.lit(False))
    as_text = [F.col(r).cast("string").alias(r) for r in found.own]
    return _unpivoted(found.frame.select(*kept, *as_text), rules, list(keys), found.own, result_col)


def rules_long_typed(df: DataFrame, rules: Mapping[str, str], keys: Sequence[str], precise: bool = False) -> DataFrame:
    """``(keys..., rule_id, type, result)``: as :func:`rules_long`, with results as VARIANTs that keep their types.

    The branches of a ``CASE``, ``if`` or ``coalesce`` that gives a rule's result are not brought to one type: of
    ``if(a > 0, 2, 'none')`` the 2 stays a number.  ``type`` names the value's type (:func:`variant_kind`); both are null
    where a rule fails.  A rule whose result has no VARIANT form (a struct, a map) is reported as not compiling.
    """
    found = _compiled(df, rules, keys, {r: VariantType() for r in rules}, precise=precise, variant=True)
    return typed_rows(found.frame, rules, keys, found.own)


def variant_kind(value: Column) -> Column:
    """The type of a VARIANT value in one word: bigint, decimal, double, string, boolean, date, array, object, ..; void: a null inside."""
    return F.lower(F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0))


def typed_rows(frame: DataFrame, rules: Mapping[str, str], keys: Sequence[str], own: Sequence[str]) -> DataFrame:
    """``(keys..., rule_id, type, result)`` of a frame of keys and one VARIANT column per rule, named ``own``."""
    kept = [F.col(_quoted(k)) for k in keys]
    if not rules:
        empty = [F.lit(None).cast(t).alias(c) for c, t in (("rule_id", "string"), ("type", "string"), ("result", "variant"))]
        return frame.select(*kept, *empty).where(F.lit(False))
    long = _unpivoted(frame, rules, list(keys), own, "result")
    return long.select(*kept, "rule_id", variant_kind(F.col("result")).alias("type"), "result")


def rules_failures(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``(n, rule_id, n_failed)``: records seen and records where the rule gave null.

    One global aggregate over the wide projection (partial counts per task,
    one row per task to the final step), then an unpivot of that single row.
    A rule that does not compile fails on every record.
    """
    found = _compiled(df, rules, (), None)
    if not rules:
        schema = "n bigint, rule_id string, n_failed bigint"
        return df.sparkSession.createDataFrame([], schema)
    counts = found.frame.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(r).isNull()).alias(r) for r in found.own])
    return _unpivoted(counts, rules, ["n"], found.own, "n_failed")


def rules_reasons(df: DataFrame, rules: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """``(keys..., rule_id, reason)``: one row per record and rule that fails on it.

    Two evaluations: the forgiving one of :func:`rules_wide`, and, only where it gave null, a strict one (ANSI mode, helpers that
    raise) which tells an error from a null the rule means to give.  The reason names the innermost part that raises (an error
    class of Spark where there is one; ``NO_SUCH_ELEMENT``, ``SUBSTRING_OUT_OF_RANGE``, ``NUMBER_FORMAT``,
    ``NULL_ARGUMENT`` for the helpers; ``DOES_NOT_COMPILE`` for a rule that does not).  One narrow pass; records on which
    no rule is null are dropped before the strict evaluation.
    """
    found = _compiled(df, rules, keys, None, also=df.columns)
    bad = {p.rule_id for p in found.problems}
    if not rules:
        return found.frame.select(*[F.col(_quoted(k)) for k in keys], F.lit("").alias("rule_id"), F.lit("").alias("reason")).where(F.lit(False))
    free = _prefix(df)
    key_names = [f"{free}key{i}" for i in range(len(keys))]
    failing = found.frame.where(" or ".join(f"{r} is null" for r in found.own))
    # The record's own names again, so that the rules' text finds them; nulls of the forgiving pass beside them.
    variables = [F.col(f"{free}var{i}").alias(c) for i, c in enumerate(df.columns)]
    kept = [F.col(f"{free}var{df.columns.index(k)}").alias(n) for k, n in zip(keys, key_names)]
    spread = strict(failing.select(*kept, *variables, *[F.col(r).isNull().alias(f"{free}null{i}") for i, r in enumerate(found.own)]))
    reasons = Reasons(df.sparkSession)
    columns = []
    for i, (rule_id, text) in enumerate(rules.items()):
        why = F.lit(NOT_COMPILED) if rule_id in bad else reasons.column(parse(spread.sparkSession, text, with_expressions=True))
        column = F.when(F.col(f"{free}null{i}"), why).cast("string").alias(found.own[i])
        if rule_id not in bad:
            try:
                spread.select(column)
            except PySparkException:  # compiles without ANSI mode only, where nothing tells its nulls apart
                column = F.lit(None).cast("string").alias(found.own[i])
        columns.append(column)
    wide = back(spread.select(*key_names, *columns), df)
    named = wide.select(*[F.col(n).alias(k) for n, k in zip(key_names, keys)], *found.own)
    return _unpivoted(named, rules, list(keys), found.own, "reason").where("reason is not null")


def evaluate_record(
    spark, rules: Mapping[str, str], record: Mapping[str, Any], schema: str | None = None
) -> dict[str, Any]:
    """Evaluate rules against one record of named values; ``{rule_id: value}``.

    The single-record form of :func:`rules_wide`, for checking rules by hand:
    the record becomes a one-row DataFrame.  Types are inferred (Python ints
    become BIGINT) unless ``schema`` gives them, e.g. ``"length INT, text1 STRING"``
    in the record's key order.  A failing or non-compiling rule gives None.
    For tables, use :func:`rules_wide`; never loop over records with this.
    """
    if schema is None:  # a null has no type of its own: it is a string variable
        known = {k: v for k, v in record.items() if v is not None}
        df = spark.createDataFrame([tuple(known.values())], list(known)) if known else spark.range(1).select()
        df = df.withColumns({k: F.lit(None).cast("string") for k, v in record.items() if v is None})
    else:
        df = spark.createDataFrame([tuple(record.values())], schema)
    return dict(zip(rules, _compiled(df, rules, (), None).frame.first()))
