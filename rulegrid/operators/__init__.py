from rulegrid.operators.dynamic import rules_variant
from rulegrid.operators.joined_rows import join_rows
from rulegrid.operators.keyed_sums import (
    DEFAULT_ORG_CONSTANT,
    RESULT_COLUMNS,
    filter_in_lists,
    group_sum,
    in_keys_group_sum,
    in_list_group_sum,
    in_list_group_sum_from_keys,
    join_group_sum,
    join_two_keys,
)
from rulegrid.operators.rules import (
    RuleProjection,
    RuleProblem,
    check_rules,
    evaluate_record,
    project_rules,
    rules_failures,
    rules_long,
    rules_long_typed,
    rules_reasons,
    rules_wide,
)

__all__ = [
    "DEFAULT_ORG_CONSTANT",
    "RESULT_COLUMNS",
    "RuleProjection",
    "RuleProblem",
    "check_rules",
    "evaluate_record",
    "project_rules",
    "filter_in_lists",
    "group_sum",
    "in_keys_group_sum",
    "in_list_group_sum",
    "in_list_group_sum_from_keys",
    "join_group_sum",
    "join_rows",
    "join_two_keys",
    "rules_failures",
    "rules_long",
    "rules_long_typed",
    "rules_reasons",
    "rules_variant",
    "rules_wide",
]
