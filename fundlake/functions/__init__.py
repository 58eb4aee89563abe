"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from fundlake.functions.numeric import (EXACT_TYPE, exact_round, exact_sum, exact_avg,
                                        safe_div, to_col)
from fundlake.functions.casting import lenient_cast
from fundlake.functions.rules import bucketize_expr, first_match_expr

__all__ = ["EXACT_TYPE", "exact_round", "exact_sum", "exact_avg", "safe_div", "to_col",
           "lenient_cast", "bucketize_expr", "first_match_expr"]
