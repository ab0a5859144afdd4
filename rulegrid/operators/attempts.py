"""Null on error for any rule, and the reason of an error, per record.

Spark's own ``try_*`` functions are built on an expression that gives null where its argument raises; :func:`attempt`
puts any column into it.  Two things evaluate parts of a column elsewhere, outside of that expression, and a raise
there would stop the job:

* common subexpressions of a projection are computed once, before its columns.  They are never taken out of a branch
  of a ``CASE`` without ``ELSE``, so a guarded rule is such a branch; its condition always holds, which the optimiser cannot know;
* arguments of SQL functions are projected below.  Where an argument may raise, the helper functions are put in as
  columns of their own (:data:`HELPERS`), whose arguments are bound by a one-element ``transform``.

Rules of which every part is known not to raise (:func:`is_total`) need no guard and keep the shared subexpressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

# Parts that never raise when analysed without ANSI mode, given that their own parts do not.
TOTAL_NODES = frozenset(
    "UnresolvedAttribute Literal Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus Cast And Or Not EqualTo EqualNullSafe "
    "GreaterThan GreaterThanOrEqual LessThan LessThanOrEqual In IsNull IsNotNull CaseWhen If Coalesce Concat".split()
)
TOTAL_FUNCTIONS = frozenset(
    "split_at substr_strict parse_int parse_long try_add try_subtract try_multiply try_divide try_mod concat coalesce if nvl ifnull nullif "
    "between upper lower length char_length trim ltrim rtrim abs size get concat_ws greatest least array isnull isnotnull round floor ceil".split()
)
PATTERNS = {"split_at": 1, "split": 1, "rlike": 1, "regexp": 1, "regexp_like": 1, "regexp_replace": 1, "regexp_extract": 1, "RLike": 1}


@dataclass(eq=False)
class Node:
    """A part of a parsed rule."""

    kind: str
    name: str = ""  # of a function
    value: str | None = None  # of a literal; the name of a column
    type: str = ""
    parts: list[Node] = field(default_factory=list)
    expression: object = None  # its own parsed expression, where asked for

    def walk(self):
        yield self
        for p in self.parts:
            yield from p.walk()


def parse(spark: SparkSession, text: str, with_expressions: bool = False) -> Node:
    """The parsed rule; raises ``ParseException`` for text that is none."""
    parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    rows = iter(json.loads(parsed.toJSON()))

    def read(expression) -> Node:
        row = next(rows)
        name = str(row.get("nameParts", ""))[1:-1].lower() if row["class"].endswith("UnresolvedFunction") else ""
        kind = row["class"].rsplit(".", 1)[-1]
        value = row.get("value") if isinstance(row.get("value"), str) else None
        if kind == "UnresolvedAttribute":
            value = str(row.get("nameParts", ""))[1:-1].lower()
        node = Node(kind, name, value, str(row.get("dataType", "")), [], expression)
        children = expression.children() if expression is not None else None
        node.parts = [read(children.apply(i) if children is not None else None) for i in range(row["num-children"])]
        return node

    return read(parsed if with_expressions else None)


def bad_pattern(spark: SparkSession, rule: Node) -> str | None:
    """The message of a constant pattern in ``rule`` that no record can satisfy."""
    for node in rule.walk():
        at = PATTERNS.get(node.name or node.kind)
        if at is not None and len(node.parts) > at and node.parts[at].kind == "Literal" and node.parts[at].value is not None:
            try:
                spark._jvm.java.util.regex.Pattern.compile(node.parts[at].value)
            except Exception as exc:  # noqa: BLE001 - whatever the gateway wraps the JVM's exception in
                return f"bad pattern {node.parts[at].value!r}: {str(exc).strip().splitlines()[-1]}"
    return None


def is_total(df: DataFrame, rule: Node) -> bool:
    """Whether no part of ``rule`` can raise on any record (when analysed without ANSI mode)."""
    simple = all(isinstance(f.dataType, (NumericType, StringType, BooleanType)) for f in df.schema.fields)
    return simple and all(_total(n) for n in rule.walk())


def _total(node: Node) -> bool:
    if node.kind == "UnresolvedFunction":
        constant = node.name != "split_at" or len(node.parts) == 3 and node.parts[1].kind == "Literal"
        return node.name in TOTAL_FUNCTIONS and constant
    return node.kind in TOTAL_NODES and not node.type.startswith(("interval", "date", "timestamp", "time"))


def _utils(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.classic.ExpressionUtils


def attempt(column: Column) -> Column:
    """``column``, or null where it raises.  Only for columns that are no common part of a projection: see :func:`guarded`."""
    spark = SparkSession.getActiveSession()
    inner = _utils(spark).expression(column._jc)
    return Column(_utils(spark).column(spark._jvm.org.apache.spark.sql.catalyst.expressions.TryEval(inner)))


def guarded(column: Column) -> Column:
    """``column``, or null where it raises, safe from being shared with other columns."""
    return attempt(F.when(F.spark_partition_id() >= 0, column))


def _bound(values: list[Column], body: Callable[..., Column]) -> Column:
    """``body`` over ``values``, each evaluated once per record."""
    row = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.get(F.transform(F.array(row), lambda x: body(*[x[f"v{i}"] for i in range(len(values))])), F.lit(0))


def _checked(found: Column, value: Column, reason: str | None) -> Column:
    """``value`` where ``found``; otherwise null, or ``reason`` raised."""
    return F.when(found, value).otherwise(F.raise_error(F.lit(reason))) if reason else F.when(found, value)


def _known(strict: bool, values: list[Column], body: Callable[..., Column]) -> Column:
    def run(*own: Column) -> Column:
        if not strict:
            return body(*own)
        missing = own[0].isNull()
        for v in own[1:]:
            missing = missing | v.isNull()
        return F.when(missing, F.raise_error(F.lit("NULL_ARGUMENT"))).otherwise(body(*own))

    return _bound(values, run)


def _split_at(strict: bool, s: Column, rx: Column, k: Column) -> Column:
    def element(parts: Column, k: Column) -> Column:
        there = (k >= 0) & ((F.size(parts) == 1) | (F.array_join(F.slice(parts, k + 1, F.size(parts)), "") != ""))
        value = F.get(parts, k)
        return _checked(F.coalesce(there & value.isNotNull(), F.lit(False)) if strict else there, value, "NO_SUCH_ELEMENT" if strict else None)

    return _known(strict, [s, rx, k], lambda s, rx, k: _bound([F.call_function("split", s, rx, F.lit(-1)), k.cast("int")], element))


def _substr_strict(strict: bool, s: Column, b: Column, e: Column) -> Column:
    def part(s: Column, b: Column, e: Column) -> Column:
        inside = (b >= 0) & (b <= e) & (e <= F.char_length(s))
        return _checked(inside, F.substring(s, b.cast("int") + 1, (e - b).cast("int")), "SUBSTRING_OUT_OF_RANGE" if strict else None)

    return _known(strict, [s, b, e], part)


def _parse(kind: str) -> Callable:
    def helper(strict: bool, s: Column) -> Column:
        def number(s: Column) -> Column:
            fits = F.call_function("regexp_like", s, F.lit(r"^[+-]?[0-9]+\z")) & s.try_cast(kind).isNotNull()
            return _checked(fits, s.try_cast(kind), "NUMBER_FORMAT" if strict else None)

        return _known(strict, [s], number)

    return helper


HELPERS: dict[str, Callable[..., Column]] = {"split_at": _split_at, "substr_strict": _substr_strict, "parse_int": _parse("int"), "parse_long": _parse("bigint")}


def variables(rule: Node, taken: frozenset[str] = frozenset()) -> list[tuple[Node, str]]:
    """The places of ``rule``'s variables with their names as written; arguments of its lambda functions (``taken``) are none.

    Inside a lambda function, Spark's parser makes no difference between its arguments and variables."""
    if rule.kind in ("UnresolvedAttribute", "UnresolvedNamedLambdaVariable"):
        parts = rule.expression.nameParts()
        name = ".".join(parts.apply(i) for i in range(parts.size()))
        return [] if name.lower() in taken else [(rule, name)]
    if rule.kind == "LambdaFunction":
        own = frozenset(p.expression.nameParts().apply(0).lower() for p in rule.parts[1:])
        return variables(rule.parts[0], taken | own)
    return [x for p in rule.parts for x in variables(p, taken)]


class Inlined:
    """A parsed rule as a column without SQL functions; with ``strict`` its helpers raise where the JDK's calls throw.

    ``bound``: columns that stand for parts of the rule."""

    def __init__(self, spark: SparkSession, strict: bool, bound: dict[Node, Column] | None = None):
        self.spark, self.strict, self.bound = spark, strict, bound or {}
        self.built: dict[Node, object] = {}

    def _expression(self, node: Node):
        if node not in self.built:
            own = [self._expression(p) for p in node.parts]
            if node in self.bound:
                self.built[node] = _utils(self.spark).expression(self.bound[node]._jc)
            elif node.name in HELPERS:
                self.built[node] = _utils(self.spark).expression(HELPERS[node.name](self.strict, *map(self._as_column, own))._jc)
            else:
                self.built[node] = node.expression.withNewChildren(self.spark._jvm.PythonUtils.toSeq(own)) if own else node.expression
        return self.built[node]

    def _as_column(self, expression) -> Column:
        return Column(_utils(self.spark).column(expression))

    def column(self, node: Node) -> Column:
        return self._as_column(self._expression(node))


_WHOLE, _FRACTIONAL = "decimal(20,0)", "decimal(30,10)"
_SUMS = {
    "Add": lambda x, y: x + y, "Subtract": lambda x, y: x - y, "Multiply": lambda x, y: x * y, "Remainder": lambda x, y: x % y,
    "try_add": F.try_add, "try_subtract": F.try_subtract, "try_multiply": F.try_multiply,
}
_ADDED, _TERM = {"Add", "Subtract", "try_add", "try_subtract"}, "decimal(37,10)"
_QUOTIENTS = {"Divide", "IntegralDivide", "div", "try_divide"}
PLACES = 10


class Precise:
    """A parsed rule with decimal arithmetic: its literals, columns and division, not its text.

    Operands of arithmetic become decimals (whole numbers ``decimal(20,0)``, floating ones ``decimal(30,10)``), ``/`` and ``div`` divide
    exactly, rounded to ten places, and an arithmetic result is ``decimal(38,10)``.  A product with fractions keeps six places at least.  What is no operand (positions in a text, list
    members, branches of other types) stays as it is.
    """

    def __init__(self, df: DataFrame):
        self.utils, self.spark = _utils(df.sparkSession), df.sparkSession
        self.types = {f.name.lower(): f.dataType for f in df.schema.fields}

    def column(self, rule: Node) -> Column:
        own = self._column(rule)
        return own.cast(f"decimal(38,{PLACES})") if self._arithmetic(rule) else own

    def _arithmetic(self, node: Node) -> bool:
        return (node.name or node.kind) in _SUMS.keys() | _QUOTIENTS | {"UnaryMinus"}

    def _operand(self, node: Node) -> Column:
        own = self._column(node)
        if self._arithmetic(node):
            return own
        kind = node.type
        if node.kind == "UnresolvedAttribute":
            found = self.types.get(node.value or "")
            kind = found.simpleString() if found else ""
        if kind.startswith("decimal"):
            return own
        whole = kind in ("tinyint", "smallint", "int", "integer", "bigint", "long") or node.name in ("parse_int", "parse_long", "length", "char_length", "size")
        return own.cast(_WHOLE if whole else _FRACTIONAL)

    def _column(self, node: Node) -> Column:
        name = node.name or node.kind
        if name in _SUMS and len(node.parts) == 2:
            x, y = map(self._operand, node.parts)
            if name in _ADDED:  # a sum of two such numbers has room for all ten places
                x, y = (v.cast(_TERM) if self._arithmetic(p) else v for v, p in zip((x, y), node.parts))
            return _SUMS[name](x, y)
        if name in _QUOTIENTS and len(node.parts) == 2:
            x, y = map(self._operand, node.parts)
            return F.round(x / y, PLACES)
        if name == "UnaryMinus":
            return -self._operand(node.parts[0])
        if not node.parts:
            return Column(self.utils.column(node.expression))
        parts = [self.utils.expression(self._column(p)._jc) for p in node.parts]
        return Column(self.utils.column(node.expression.withNewChildren(self.spark._jvm.PythonUtils.toSeq(parts))))


def typed(rule: Node, build: Callable[[Node], Column]) -> Column:
    """``rule`` as a VARIANT: every branch that may give the result keeps its own type.  ``build`` makes the parts' columns."""
    name = rule.name or rule.kind
    if name == "CaseWhen" or name == "if":
        *pairs, last = rule.parts if len(rule.parts) % 2 else [*rule.parts, None]
        out = F
        for condition, value in zip(pairs[::2], pairs[1::2]):
            out = out.when(build(condition), typed(value, build))
        return out.otherwise(typed(last, build)) if last else out
    if name in ("coalesce", "nvl", "ifnull"):
        return F.coalesce(*[typed(p, build) for p in rule.parts])
    return build(rule).cast("variant")


def forgiving(df: DataFrame, text: str, precise: bool = False, variant: bool = False) -> Column:
    """The column of a rule that gives null where it raises; for use on ``lenient(df)``.  ``variant``: with its type in the value."""
    spark = df.sparkSession
    rule = parse(spark, text)
    if variant:
        build = (Precise(df) if precise else Inlined(spark, False)).column
        column = typed(parse(spark, text, with_expressions=True), build)
        return column if is_total(df, rule) else guarded(column)
    if is_total(df, rule):
        return Precise(df).column(parse(spark, text, with_expressions=True)) if precise else F.expr(text)
    if precise:
        return guarded(Precise(df).column(parse(spark, text, with_expressions=True)))
    hoisted = any(n.name in HELPERS and not all(_total(x) for p in n.parts for x in p.walk()) for n in rule.walk())
    return guarded(Inlined(spark, False).column(parse(spark, text, with_expressions=True)) if hoisted else F.expr(text))


def _with_mode(df: DataFrame, ansi: bool) -> DataFrame:
    """``df`` in a session of its own that differs in ANSI mode only, so no other query sees the setting."""
    spark = df.sparkSession
    own = spark._jsparkSession.cloneSession()
    own.conf().set("spark.sql.ansi.enabled", "true" if ansi else "false")
    jdf = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own, df._jdf.queryExecution().analyzed())
    session = SparkSession(spark.sparkContext, own, options={})
    return DataFrame(jdf, session)


def lenient(df: DataFrame) -> DataFrame:
    return _with_mode(df, False)


def strict(df: DataFrame) -> DataFrame:
    return _with_mode(df, True)


def back(df: DataFrame, to: DataFrame) -> DataFrame:
    """``df``, analysed in a session of its own, as a DataFrame of ``to``'s session."""
    spark = to.sparkSession
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, df._jdf.queryExecution().analyzed()), spark)


# Fixed names: the reason of an error by the part that raised it; Spark's own error classes where it has one.
REASONS = {
    "Cast": "CAST_INVALID_INPUT", "UnresolvedExtractValue": "INVALID_ARRAY_INDEX", "raise_error": "USER_RAISED_EXCEPTION",
    "sequence": "ILLEGAL_SEQUENCE", "to_number": "INVALID_FORMAT", "split_part": "INVALID_INDEX_OF_ZERO",
    "split_at": "NO_SUCH_ELEMENT", "substr_strict": "SUBSTRING_OUT_OF_RANGE", "parse_int": "NUMBER_FORMAT", "parse_long": "NUMBER_FORMAT",
    **dict.fromkeys(["Add", "Subtract", "Multiply", "UnaryMinus", "abs"], "ARITHMETIC_OVERFLOW"),
    **dict.fromkeys(["split", "rlike", "regexp", "regexp_like", "regexp_replace", "regexp_extract", "RLike"], "INVALID_PATTERN"),
}
DIVISIONS = {"Divide", "IntegralDivide", "Remainder", "pmod", "mod"}
NOT_COMPILED = "DOES_NOT_COMPILE"


class Reasons:
    """Why a rule raises on a record: the reason of the innermost part that raises by itself, in order of evaluation."""

    def __init__(self, spark: SparkSession):
        self.inlined = Inlined(spark, True)

    def _raises(self, node: Node) -> Column:
        return attempt(F.struct(self.inlined.column(node))).isNull()

    def _value(self, node: Node) -> Column:
        return attempt(self.inlined.column(node))

    def _own(self, node: Node) -> Column:
        name = node.name or node.kind
        if name in DIVISIONS:
            return F.when(self._value(node.parts[1]) == 0, "DIVIDE_BY_ZERO").otherwise("ARITHMETIC_OVERFLOW")
        if name == "element_at":
            return F.when(self._value(node.parts[1]).cast("string") == "0", "INVALID_INDEX_OF_ZERO").otherwise("INVALID_ARRAY_INDEX_IN_ELEMENT_AT")
        own = F.lit(REASONS.get(name, f"{name.upper()}_FAILED"))
        if name in HELPERS:
            missing = self._value(node.parts[0]).isNull()
            for p in node.parts[1:]:
                missing = missing | self._value(p).isNull()
            return F.when(missing, "NULL_ARGUMENT").otherwise(own)
        return own

    def of(self, node: Node) -> Column:
        """The reason, for records on which ``node`` raises."""
        parts = [p for p in node.parts if p.kind not in ("UnresolvedAttribute", "Literal")]
        if not parts or any(p.kind == "LambdaFunction" for p in node.parts):
            return self._own(node)
        steps: list[tuple[Column, Column]] = []
        if node.kind == "CaseWhen" or node.name == "if":
            for condition, value in zip(node.parts[::2], node.parts[1::2]):
                steps += [(self._raises(condition), self.of(condition)), (self._value(condition), self.of(value))]
            last = self.of(node.parts[-1]) if len(node.parts) % 2 else self._own(node)
        else:
            steps = [(self._raises(p), self.of(p)) for p in parts]
            last = self._own(node)
        first, *rest = steps
        found = F.when(*first)
        for step in rest:
            found = found.when(*step)
        return found.otherwise(last)

    def column(self, rule: Node) -> Column:
        """The reason where ``rule`` raises, null elsewhere; for use on ``strict(df)``, in a branch of a ``CASE``."""
        return F.when(self._raises(rule), self.of(rule))
