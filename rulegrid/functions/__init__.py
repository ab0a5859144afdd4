from rulegrid.functions.javalike import (
    FUNCTION_NAMES,
    parse_int,
    parse_long,
    register_functions,
    split_at,
    substr_strict,
)

__all__ = [
    "FUNCTION_NAMES",
    "parse_int",
    "parse_long",
    "register_functions",
    "split_at",
    "substr_strict",
]
