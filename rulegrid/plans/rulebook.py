"""The ten example rules, written as Spark SQL over one record of variables.

Each rule re-expresses one example expression of the source, in its order.
Where the source's four expression dialects disagree, the choice is explicit:

* ``/`` is integer division in one dialect and exact or 10-digit decimal
  division in the others, so rule 7 exists in both forms.
* Integer parsing is 32-bit (``parse_int``); the 64-bit dialect's form is
  ``EXAMPLE_RULES_LONG``.
* Overflow of ``+``/``*`` yields null (``try_*``), where the JVM would wrap.
* Rule 8 returns ``'2'`` or ``'1 or 0'``: both branches are strings, since a
  column has one type.

A rule whose input makes the source call throw (index past the end of a
split, substring past the end, unparsable number) is null here.
"""

from __future__ import annotations

# Discriminant of rule 8: (a+b)*(a+b) - 4*a*c, null on overflow.
_DISCRIMINANT = "try_subtract(try_multiply(try_add(a, b), try_add(a, b)), try_multiply(try_multiply(4, a), c))"

# The example rules in source order, plus the two forms of rule 7.
# Literals that must stay as they are: ':' '\\|' '\\.' '.step' '.UNIT' '.'
# substring ends 3 and 4, the addend 5, the divisor 3, the branch values 2 and
# '1 or 0', and the membership list 1, 2, 3, 4, 5.
EXAMPLE_RULES = {
    "r1": r"split_at(text1, ':', 1) || '.step'",
    "r2": r"split_at(text2, ':', 1) || '.step'",
    "r3": r"split_at(text3, '\\|', 1) || '.' || substr_strict(split_at(split_at(text3, '\\|', 0), ':', 1), 0, 3) || '.UNIT'",
    "r4": r"split_at(text4, '\\|', 1) || '.' || substr_strict(split_at(split_at(text4, '\\|', 0), '\\.', 1), 0, 4) || '.UNIT'",
    "r5": r"try_add(parse_int(split_at(text5, ':', 1)), 5)",
    "r6": r"try_add(parse_int(split_at(text6, ':', 1)), 5)",
    "r7_int": r"length div 3",
    "r7_dec": r"cast(round(cast(length AS decimal(20, 0)) / cast(3 AS decimal(20, 0)), 10) AS decimal(38, 10))",
    "r8": f"CASE WHEN {_DISCRIMINANT} > 0 THEN '2' WHEN {_DISCRIMINANT} <= 0 THEN '1 or 0' END",
    "r9": r"try_add(try_add(d, e div 3), try_multiply(d, e))",
    "r10": r"coalesce(f IN (1, 2, 3, 4, 5), false)",
}

# The precise-number dialect divides integers exactly, rounded to 10 places.
EXAMPLE_RULES_DECIMAL = {
    "r9_dec": r"cast(try_add(try_add(cast(d AS decimal(20, 0)), round(cast(e AS decimal(20, 0)) / cast(3 AS decimal(20, 0)), 10)), try_multiply(d, e)) AS decimal(38, 10))",
}

# The 64-bit dialect parses with long(...).
EXAMPLE_RULES_LONG = {
    "r5_long": r"try_add(parse_long(split_at(text5, ':', 1)), 5)",
    "r6_long": r"try_add(parse_long(split_at(text6, ':', 1)), 5)",
}


# Rules as a user would first write them, and one with a bad pattern: what fails on a record gives null.
PLAIN_RULES = {
    "p_cast": r"cast(text1 AS int)",
    "p_cast_part": r"cast(get(split(text5, ':'), 1) AS int) + 5",
    "p_zero": r"(d + 1) / b",
    "p_index": r"split(text1, ':')[9]",
    "p_wrap": r"cast(2147483647 AS int) + cast(a AS int)",
    "p_pattern": r"split_at(text1, '(', 1)",
}


# Valid rules that raise on some records: there they give null, elsewhere their value.
RAISING_RULES = {
    "v_index": r"element_at(split(text1, ':'), cast(a - 1 AS int))",
    "v_part": r"split_part(text1, '2', cast(a - 1 AS int))",
    "v_size": r"size(sequence(2L, 8L, a - 1))",
    "v_number": r"to_number(text1, '999')",
    "v_branch": r"CASE WHEN a = 1 THEN raise_error('one') ELSE a END",
    "v_zero": r"element_at(split(text1, ':'), cast(c AS int))",
    "v_zero_too": r"element_at(split(text1, ':'), cast(c AS int)) || '.step'",
    "v_step": r"size(sequence(1L, a, c))",
    "v_pattern": r"split(text1, substring('(:', cast(c AS int), 1))[0]",
    "v_nested": r"split_at(element_at(split(text1, ':'), cast(c AS int)), 'e', 0)",
}

# Rules whose failures are explained, beside some that give null on purpose.
EXPLAINED_RULES = {
    "x_cast": r"cast(text1 AS int)",
    "x_zero": r"d div b",
    "x_index": RAISING_RULES["v_zero"],
    "x_branch": RAISING_RULES["v_branch"],
    "x_inner": r"coalesce(upper(split_at(text1, ':', 1)), 'none') || cast(d div b AS string)",
    "x_meant": r"CASE WHEN a > 3 THEN a END",
    "x_meant_too": r"nullif(a, 3)",
    "x_bad": r"no_such_variable + 1",
}


# Rules with results of mixed types; rule 8 as the source has it, a number or a text.
MIXED_RULES = {
    "m8": f"CASE WHEN {_DISCRIMINANT} > 0 THEN 2 WHEN {_DISCRIMINANT} <= 0 THEN '1 or 0' END",
    "m_if": r"if(f IS NULL, false, if(f > 4, f, 'few'))",
    "m_first": r"coalesce(parse_int(split_at(text5, ':', 1)), split_at(text5, ':', 1))",
}

# Rules over records whose variables differ in type from record to record.
DYNAMIC_RULES = {
    "y_add": "d + 1",
    "y_text": r"split_at(text1, ':', 1) || '.step'",
    "y_join": "concat(d, '/', text1)",
    "y_member": "f IN (1, 2, 3, 4, 5)",
    "y_mixed": "CASE WHEN length % 2 = 0 THEN length div 3 ELSE text1 END",
    "y_part": "try_add(parse_int(split_at(d, '[.]', 0)), 5)",
    "y_missing": "no_such_variable + 1",
}


def pick(*rule_ids: str) -> dict[str, str]:
    merged = {**EXAMPLE_RULES, **EXAMPLE_RULES_DECIMAL, **EXAMPLE_RULES_LONG}
    return {rule_id: merged[rule_id] for rule_id in rule_ids}
