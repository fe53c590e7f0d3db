"""Column expressions shared by the operators (all built-in, no UDFs)."""

from linkrank.functions.columns import (
    hash_order,
    ratio_or_zero,
    round_to,
    strip_ws,
)

__all__ = ["hash_order", "ratio_or_zero", "round_to", "strip_ws"]
