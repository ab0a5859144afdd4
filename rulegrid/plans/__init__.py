from rulegrid.plans.keysets import BROADCAST_MAX_KEYS, LITERAL_MAX_KEYS, KeySets, key_lists_or_sets, key_sets
from rulegrid.plans.rulebook import EXAMPLE_RULES, EXAMPLE_RULES_LONG, pick

__all__ = [
    "BROADCAST_MAX_KEYS",
    "EXAMPLE_RULES",
    "EXAMPLE_RULES_LONG",
    "LITERAL_MAX_KEYS",
    "KeySets",
    "key_lists_or_sets",
    "key_sets",
    "pick",
]
