"""Panel operators: bridge expansion, strict sums, densify, shares, base years, templates."""

from .bounded import Small, prove_bound  # noqa: F401
from .panel import (Via, OBSERVED, attach_grid, base_year_rows, baseline_shift, bridged_state, densify,  # noqa: F401
                    expand, expand_and_sum, finish_sum, group_share, union_all)
from .template import conform, convert_by_category, convert_by_pattern, scaled, tag  # noqa: F401
