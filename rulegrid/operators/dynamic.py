"""Rules over records of dynamic type: one VARIANT column of named values, typed per record.

The same variable may be a number in one record and a text in the next.  A rule is compiled once for every combination of types
that its own variables have in the table (found by one aggregate, or given by the caller), and a record is evaluated by the
branch of its combination: one narrow pass, inside the JVM, however many combinations there are.
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulegrid.functions import register_functions
from rulegrid.operators.attempts import Inlined, Node, back, bad_pattern, guarded, lenient, parse, typed, variables
from rulegrid.operators.rules import _prefix, _project, _quoted, typed_rows, variant_kind

log = logging.getLogger(__name__)

MAX_COMBINATIONS = 512

# The column type that a variable of a kind is bound to; kinds that are not here (arrays, objects) stay VARIANTs.
BOUND_TYPES = {
    "bigint": "bigint", "decimal": "decimal(38,10)", "float": "float", "double": "double", "string": "string", "boolean": "boolean",
    "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp_ntz", "binary": "binary", "void": "string",
}


def _field(record: str, name: str, kind: str = "variant") -> Column:
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(F.col(_quoted(record)), f"$[{quote}{name}{quote}]", kind)


def _combinations(df: DataFrame, signatures: Mapping[str, Column], used: Mapping[str, list[str]], kinds: Mapping[str, Sequence[str]] | None) -> dict[str, list[list[str]]]:
    """Per rule the combinations of kinds of its variables: those of ``kinds``, or those that occur in ``df``."""
    if kinds is not None:
        return {r: [list(x) for x in itertools.product(*[dict.fromkeys([*kinds.get(v, ()), "void"]) for v in names])] for r, names in used.items()}
    if not signatures:
        return {}
    found = df.agg(*[F.array_sort(F.collect_set(s)).alias(f"s{i}") for i, s in enumerate(signatures.values())]).first()
    return {r: [x.split(",") if x else [] for x in found[i]] for i, r in enumerate(signatures)}


def rules_variant(df: DataFrame, record: str, rules: Mapping[str, str], keys: Sequence[str], kinds: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``(keys..., rule_id, type, result)`` of rules whose variables are the fields of the VARIANT column ``record``.

    Fields are bound by name (as written) and typed per record by :func:`variant_kind`; a field that is missing or null is a null
    string.  Decimals are bound as ``decimal(38,10)``.  A rule that does not compile for a record's types, or raises on it, gives
    null there.  ``kinds``: the types that each variable may have (a record of others gives null), which spares the pass over
    the table that finds the combinations.  More than ``MAX_COMBINATIONS`` of one rule are an error.
    """
    spark = df.sparkSession
    register_functions(spark)
    trees: dict[str, Node] = {}
    for rule_id, text in rules.items():
        try:
            problem = bad_pattern(spark, parse(spark, text))
            if not problem:
                trees[rule_id] = parse(spark, text, with_expressions=True)
        except PySparkException as exc:
            problem = str(exc).strip().splitlines()[0]
        if problem:
            log.info("rule %s does not compile: %s", rule_id, problem)
    places = {r: variables(tree) for r, tree in trees.items()}
    used = {r: sorted({name for _, name in own}) for r, own in places.items()}
    free = _prefix(df)
    names = sorted({v for own in used.values() for v in own})
    kind = {v: f"{free}kind{i}" for i, v in enumerate(names)}
    kept = list(dict.fromkeys([*keys, record]))
    found = df.select(*[F.col(_quoted(c)) for c in kept], *[F.coalesce(variant_kind(_field(record, v)), F.lit("void")).alias(k) for v, k in kind.items()])
    signature = {r: F.concat_ws(",", *[F.col(kind[v]) for v in own]) for r, own in used.items()}
    combinations = _combinations(found, signature, used, kinds)
    many = [r for r, c in combinations.items() if len(c) > MAX_COMBINATIONS]
    if many:
        raise ValueError(f"over {MAX_COMBINATIONS} combinations of types in rules {many}: give their variables' kinds")

    own = lenient(found)
    columns = []
    for rule_id in rules:
        branches = F.when(F.lit(False), F.lit(None).cast("variant"))
        for combination in combinations.get(rule_id, ()):
            fields = {v: _field(record, v, BOUND_TYPES.get(k, "variant")) for v, k in zip(used[rule_id], combination)}
            bound = {node: fields[v] for node, v in places[rule_id]}
            try:
                column = typed(trees[rule_id], Inlined(own.sparkSession, False, bound).column)
                _project(own, [record], [column])
            except PySparkException as exc:
                log.info("rule %s does not compile for %s: %s", rule_id, combination, str(exc).strip().splitlines()[0])
                continue
            branches = branches.when(signature[rule_id] == ",".join(combination), column)
        columns.append(guarded(branches))
    wide = back(_project(own, keys, columns), found)
    values = [f"{free}r{i}" for i in range(len(rules))]
    frame = wide.select(*[F.col(_quoted(k)) for k in keys], *[F.col(f"{_prefix(own)}rule{i}.v").alias(n) for i, n in enumerate(values)])
    return typed_rows(frame, rules, keys, values)
