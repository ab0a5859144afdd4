"""DuckDB SQL that computes, independently of Spark, what each registered query returns.

The inputs are the same SQL text Spark runs (``rulegrid.sources.mapping``),
filled with DuckDB's view names.  The statements are plain SQL: the joined
sum really joins and then sums, the IN lists are IN subqueries.  The helper
functions are written out in DuckDB's own list functions: Java's split keeps
element ``k`` iff the regex split has one element (then ``k = 0``) or some
element from ``k`` on is non-empty.
"""

from __future__ import annotations

from rulegrid.sources.mapping import (
    ALL_KEYS_SQL,
    CONTEXTS_SQL,
    KEY_LIST_SQL,
    TABLE_A_SQL,
    TABLE_B_SQL,
    for_duckdb,
)

_A = for_duckdb(TABLE_A_SQL)
_B = for_duckdb(TABLE_B_SQL)
_KEYS = for_duckdb(KEY_LIST_SQL)
_ALL_KEYS = for_duckdb(ALL_KEYS_SQL, table_a=_A)
_CTX = for_duckdb(CONTEXTS_SQL)


def _split_at(s: str, rx: str, k: int) -> str:
    parts = f"string_split_regex({s}, '{rx}')"
    return (
        f"(CASE WHEN len({parts}) = 1 THEN {parts}[{k + 1}] "
        f"WHEN array_to_string({parts}[{k + 1}:], '') <> '' THEN {parts}[{k + 1}] END)"
    )


def _substr_strict(s: str, b: int, e: int) -> str:
    return f"(CASE WHEN {b} >= 0 AND {b} <= {e} AND {e} <= length({s}) THEN substring({s}, {b + 1}, {e - b}) END)"


def _parse(s: str, sql_type: str) -> str:
    return f"(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN try_cast({s} AS {sql_type}) END)"


def _nested(text: str, sep: str, sep2: str, n: int) -> str:
    head = _split_at(text, sep, 0)
    return (
        f"{_split_at(text, sep, 1)} || '.' || "
        f"{_substr_strict(_split_at(head, sep2, 1), 0, n)} || '.UNIT'"
    )


_X = "((a + b) * (a + b) - 4 * a * c)"

RULES_DUCKDB = {
    "r1": f"{_split_at('text1', ':', 1)} || '.step'",
    "r2": f"{_split_at('text2', ':', 1)} || '.step'",
    "r3": _nested("text3", r"\|", ":", 3),
    "r4": _nested("text4", r"\|", r"\.", 4),
    "r5": f"{_parse(_split_at('text5', ':', 1), 'INTEGER')} + 5",
    "r6": f"{_parse(_split_at('text6', ':', 1), 'INTEGER')} + 5",
    "r7_int": "length // 3",
    "r7_dec": "CAST(length / 3 AS DECIMAL(38, 10))",
    "r8": f"CASE WHEN {_X} > 0 THEN '2' WHEN {_X} <= 0 THEN '1 or 0' END",
    "r9": "(d + e // 3) + (d * e)",
    "r10": "coalesce(f IN (1, 2, 3, 4, 5), false)",
    "r9_dec": "CAST(d + CAST(e / 3 AS DECIMAL(38, 10)) + d * e AS DECIMAL(38, 10))",
    "r5_long": f"{_parse(_split_at('text5', ':', 1), 'BIGINT')} + 5",
    "r6_long": f"{_parse(_split_at('text6', ':', 1), 'BIGINT')} + 5",
}

ALL_RULES = ("r1", "r2", "r3", "r4", "r5", "r6", "r7_int", "r7_dec", "r8", "r9", "r10")


def _rules_select(rule_ids) -> str:
    cols = ",\n  ".join(f"{RULES_DUCKDB[r]} AS {r}" for r in rule_ids)
    return f"SELECT event_id,\n  {cols}\nFROM ({_CTX}) AS ctx"


def _rules_long() -> str:
    cols = ", ".join(f"CAST({r} AS VARCHAR) AS {r}" for r in ALL_RULES)
    return (
        f"SELECT event_id, rule_id, result FROM (SELECT event_id, {cols} FROM ({_rules_select(ALL_RULES)}) w) "
        f"UNPIVOT INCLUDE NULLS (result FOR rule_id IN ({', '.join(ALL_RULES)}))"
    )


def _rules_failures() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {r} IS NULL) AS {r}" for r in ALL_RULES)
    return (
        f"SELECT n, rule_id, n_failed FROM (SELECT count(*) AS n, {counts} FROM ({_rules_select(ALL_RULES)}) w) "
        f"UNPIVOT INCLUDE NULLS (n_failed FOR rule_id IN ({', '.join(ALL_RULES)}))"
    )


def _in_lists(keys: str) -> str:
    return (
        f"b.item_id IN (SELECT l.inv_item_id FROM ({keys}) AS l) "
        f"AND b.org_id IN (SELECT l.sch_org_id FROM ({keys}) AS l)"
    )


_IN_LISTS = _in_lists(_KEYS)


def _in_list_group_sum(keys: str) -> str:
    return f"""
SELECT b.org_id AS sch_org_id, 'oi001' AS org_id, b.item_id AS inv_item_id, sum(b.shuju) AS m
FROM ({_B}) AS b
WHERE {_in_lists(keys)}
GROUP BY b.org_id, b.item_id
"""


_IN_LIST_GROUP_SUM = _in_list_group_sum(_KEYS)

# Plain rules: what fails is null; an int wraps around.
_PLAIN = f"""
SELECT event_id, try_cast(text1 AS INTEGER) AS p_cast, CAST(try_cast(trim(string_split(text5, ':')[2]) AS INTEGER) + 5 AS INTEGER) AS p_cast_part,
  CASE WHEN b <> 0 THEN CAST(d + 1 AS DOUBLE) / b END AS p_zero, CAST(NULL AS VARCHAR) AS p_index,
  CAST(CASE WHEN a > 0 THEN 2147483647 + a - 4294967296 ELSE 2147483647 + a END AS INTEGER) AS p_wrap, CAST(NULL AS VARCHAR) AS p_pattern
FROM ({_CTX}) AS ctx
"""

def _element(k: str) -> str:
    parts = "string_split(text1, ':')"
    return f"(CASE WHEN {k} <> 0 AND abs({k}) <= len({parts}) THEN {parts}[{k}] END)"


def _steps(start: str, stop: str, step: str) -> str:
    """Numbers in a sequence; null where it is illegal."""
    return (
        f"CAST(CASE WHEN {step} = 0 AND {start} = {stop} THEN 1 WHEN {step} > 0 AND {start} <= {stop} "
        f"OR {step} < 0 AND {start} >= {stop} THEN ({stop} - {start}) // {step} + 1 END AS INTEGER)"
    )


# Rules that raise: null on the records on which Spark's functions raise, their value on all others.
_RAISING = f"""
SELECT event_id, {_element('(a - 1)')} AS v_index, CASE WHEN a <> 1 THEN split_part(text1, '2', a - 1) END AS v_part,
  {_steps('2', '8', '(a - 1)')} AS v_size, CAST(NULL AS DECIMAL(3, 0)) AS v_number, CASE WHEN a <> 1 THEN a END AS v_branch,
  {_element('c')} AS v_zero, {_element('c')} || '.step' AS v_zero_too, {_steps('1', 'a', 'c')} AS v_step,
  CASE WHEN c NOT IN (0, 1) THEN string_split(text1, ':')[1] END AS v_pattern, {_split_at(_element('c'), 'e', 0)} AS v_nested
FROM ({_CTX}) AS ctx
"""


def _reasons() -> str:
    no_element = f"({_split_at('text1', ':', 1)}) IS NULL"
    short = "length(CAST(event_id * 37 AS VARCHAR)) < 4"
    cases = [
        ("r1", no_element, "NO_SUCH_ELEMENT"),
        ("r4", short, "SUBSTRING_OUT_OF_RANGE"),
        ("r5", "text5 LIKE 'a: %'", "NUMBER_FORMAT"),
        ("r6", "event_id * 400000 > 2147483647", "NUMBER_FORMAT"),
        ("x_cast", "try_cast(text1 AS INTEGER) IS NULL", "CAST_INVALID_INPUT"),
        ("x_zero", "b = 0", "DIVIDE_BY_ZERO"),
        ("x_index", "c = 0", "INVALID_INDEX_OF_ZERO"),
        ("x_branch", "a = 1", "USER_RAISED_EXCEPTION"),
        ("x_inner", f"b = 0 AND NOT {no_element}", "DIVIDE_BY_ZERO"),
        ("x_inner", f"b = 0 AND {no_element}", "NO_SUCH_ELEMENT"),
        ("x_bad", "true", "DOES_NOT_COMPILE"),
    ]
    return " UNION ALL ".join(f"SELECT event_id, '{r}' AS rule_id, '{why}' AS reason FROM ({_CTX}) AS ctx WHERE {when}" for r, when, why in cases)


def _typed_rows(cases: list[tuple[str, str, str, str]]) -> str:
    """``(event_id, rule_id, type, result)`` of cases: rule, when it has a result, its type and its text."""
    return " UNION ALL ".join(
        f"SELECT event_id, '{r}' AS rule_id, CASE WHEN {when} THEN {kind} END AS type, CASE WHEN {when} THEN CAST({text} AS VARCHAR) END AS result FROM ({_CTX}) AS ctx"
        for r, when, kind, text in cases
    )


def _rules_long_typed() -> str:
    kinds = {"r1": "string", "r2": "string", "r3": "string", "r4": "string", "r5": "bigint", "r6": "bigint", "r7_int": "bigint", "r9": "bigint", "r10": "boolean"}
    own = [(r, f"({RULES_DUCKDB[r]}) IS NOT NULL", f"'{kind}'", f"({RULES_DUCKDB[r]})") for r, kind in kinds.items()]
    first, number = _split_at("text5", ":", 1), _parse(_split_at("text5", ":", 1), "INTEGER")
    return _typed_rows([
        *own,
        ("r7_dec", "true", "'decimal'", f"rtrim(rtrim(CAST({RULES_DUCKDB['r7_dec']} AS VARCHAR), '0'), '.')"),
        ("m8", "true", f"CASE WHEN {_X} > 0 THEN 'bigint' ELSE 'string' END", RULES_DUCKDB["r8"]),
        ("m_if", "true", "CASE WHEN f IS NULL THEN 'boolean' WHEN f > 4 THEN 'bigint' ELSE 'string' END",
         "CASE WHEN f IS NULL THEN 'false' WHEN f > 4 THEN CAST(f AS VARCHAR) ELSE 'few' END"),
        ("m_first", f"({first}) IS NOT NULL", f"CASE WHEN {number} IS NULL THEN 'string' ELSE 'bigint' END", f"coalesce(CAST({number} AS VARCHAR), {first})"),
    ])


def _rules_variant() -> str:
    kind = "event_id % 4"  # 0: d is a number, 1: a text, 2: a decimal and f is missing, 3: d is a truth value and text1 a number
    d = f"CASE {kind} WHEN 2 THEN CAST(CAST(d + 0.25 AS DECIMAL(38, 10)) AS VARCHAR) WHEN 3 THEN CAST(d > 5 AS VARCHAR) ELSE CAST(d AS VARCHAR) END"
    return _typed_rows([
        ("y_add", f"{kind} <> 3", f"CASE {kind} WHEN 0 THEN 'bigint' WHEN 1 THEN 'double' ELSE 'decimal' END",
         f"CASE {kind} WHEN 0 THEN CAST(d + 1 AS VARCHAR) WHEN 1 THEN CAST(CAST(d + 1 AS DOUBLE) AS VARCHAR) ELSE CAST(d + 1.25 AS VARCHAR) END"),
        ("y_text", f"{kind} <> 3 AND ({_split_at('text1', ':', 1)}) IS NOT NULL", "'string'", f"{_split_at('text1', ':', 1)} || '.step'"),
        ("y_join", "true", "'string'", f"{d} || '/' || CASE {kind} WHEN 3 THEN CAST(d AS VARCHAR) ELSE text1 END"),
        ("y_member", f"{kind} <> 2 AND f IS NOT NULL", "'boolean'", "f IN (1, 2, 3, 4, 5)"),
        ("y_mixed", "true", f"CASE WHEN {kind} = 1 THEN 'string' ELSE 'bigint' END",
         f"CASE {kind} WHEN 1 THEN text1 WHEN 3 THEN CAST(d AS VARCHAR) ELSE CAST(length // 3 AS VARCHAR) END"),
        ("y_part", f"{kind} <> 3", "'bigint'", "d + 5"),
        ("y_missing", "false", "''", "''"),
    ])


_PRECISE_RULES = {
    **{r: RULES_DUCKDB[r] for r in ("r1", "r2", "r3", "r4")},
    **{r: f"CAST({RULES_DUCKDB[r]} AS DECIMAL(38, 10))" for r in ("r5", "r6")},
    "r7_int": RULES_DUCKDB["r7_dec"], "r8": RULES_DUCKDB["r8"], "r9": RULES_DUCKDB["r9_dec"], "r10": RULES_DUCKDB["r10"],
}

ORACLE_SQL = {
    "rules_precise": "SELECT event_id, " + ", ".join(f"{x} AS {r}" for r, x in _PRECISE_RULES.items()) + f" FROM ({_CTX}) AS ctx",
    "rules_raising": _RAISING,
    "rules_reasons": _reasons(),
    "join_rows": f"""
SELECT a.sch_org_id, a.org_id, a.inv_item_id, b.shuju
FROM ({_A}) AS a, ({_B}) AS b
WHERE b.item_id = a.inv_item_id AND b.org_id = a.sch_org_id
""",
    "filter_in_key_sets": f"""
SELECT b.org_id, b.item_id, b.shuju FROM ({_B}) AS b WHERE {_IN_LISTS}
""",
    "join_two_keys": f"""
SELECT a.sch_org_id, a.org_id, a.inv_item_id, b.shuju, count(*) AS n_pairs
FROM ({_A}) AS a, ({_B}) AS b
WHERE b.item_id = a.inv_item_id AND b.org_id = a.sch_org_id
GROUP BY a.sch_org_id, a.org_id, a.inv_item_id, b.shuju
""",
    "group_sum": f"""
SELECT org_id, item_id, sum(shuju) AS m FROM ({_B}) AS b GROUP BY org_id, item_id
""",
    "join_group_sum": f"""
SELECT a.sch_org_id, a.org_id, a.inv_item_id, sum(b.shuju) AS m
FROM ({_A}) AS a, ({_B}) AS b
WHERE b.item_id = a.inv_item_id AND b.org_id = a.sch_org_id
GROUP BY a.sch_org_id, a.org_id, a.inv_item_id
""",
    "filter_in_lists": f"""
SELECT b.org_id, b.item_id, b.shuju FROM ({_B}) AS b WHERE {_IN_LISTS}
""",
    "in_list_group_sum": _IN_LIST_GROUP_SUM,
    "in_keys_group_sum": _IN_LIST_GROUP_SUM,
    "in_keys_group_sum_all": _in_list_group_sum(_ALL_KEYS),
    "statement_in_list": _IN_LIST_GROUP_SUM,
    "statement_in_keys": _IN_LIST_GROUP_SUM,
    "rules_plain": _PLAIN,
    "join_group_sum_decimal": f"""
SELECT a.sch_org_id, a.org_id, a.inv_item_id, CAST(sum(b.shuju) AS DECIMAL(28, 8)) AS m
FROM ({_A}) AS a, (SELECT org_id, item_id, CAST(item_id + 0.12345678 AS DECIMAL(18, 8)) AS shuju FROM ({_B}) AS x) AS b
WHERE b.item_id = a.inv_item_id AND b.org_id = a.sch_org_id
GROUP BY a.sch_org_id, a.org_id, a.inv_item_id
""",
    "rules_wide": _rules_select(ALL_RULES),
    "rules_long": _rules_long(),
    "rules_long_typed": _rules_long_typed(),
    "rules_variant": _rules_variant(),
    "rules_failures": _rules_failures(),
    "rule_split_index": _rules_select(("r1", "r2")),
    "rule_nested_split": _rules_select(("r3", "r4")),
    "rule_parse_add": _rules_select(("r5", "r6")),
    "rule_parse_add_long": _rules_select(("r5_long", "r6_long")),
    "rule_divide_integer": _rules_select(("r7_int",)),
    "rule_divide_decimal": _rules_select(("r7_dec",)),
    "rule_ternary": _rules_select(("r8",)),
    "rule_arith": _rules_select(("r9",)),
    "rule_arith_decimal": _rules_select(("r9_dec",)),
    "rule_member": _rules_select(("r10",)),
}
