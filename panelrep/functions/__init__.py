"""Native Column expressions for the null, NaN, division and text rules."""

from .nullmath import contains_or_false, fill_missing, ieee_div, if_else3, strict_sum  # noqa: F401
from .text import recover_origin, split_key, with_split_key  # noqa: F401
