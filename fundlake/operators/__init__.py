"""Pure ``DataFrame -> DataFrame`` operators; no table names inside."""

from fundlake.operators.aggregates import (attach_scalar, global_stats, group_enrich, lookup,
                                           weighted_mean)
from fundlake.operators.bands import (band_summary, bucketize, first_match, leverage_bands,
                                      moic_bands, risk_flag)
from fundlake.operators.concentration import concentration, hhi, weights
from fundlake.operators.ratios import difference, product, ratio, total, years_held
from fundlake.operators.returns import irr, irr_check, multiples_check
from fundlake.operators.reshape import flatten, to_snake, unpivot_years
from fundlake.operators.series import (cagr, distributed_lag, growth, latest_per_key,
                                       number_rows, running_total, with_cagr)
from fundlake.operators.typing import cast_rejects, cast_report, typed_select

__all__ = ["attach_scalar", "global_stats", "group_enrich", "lookup", "weighted_mean",
           "band_summary", "bucketize", "first_match", "leverage_bands", "moic_bands",
           "risk_flag", "concentration", "hhi", "weights", "difference", "product", "ratio",
           "total", "years_held", "flatten", "to_snake", "unpivot_years", "cagr", "growth",
           "latest_per_key", "number_rows", "running_total", "with_cagr", "distributed_lag", "cast_rejects", "cast_report",
           "typed_select", "irr", "irr_check", "multiples_check"]
