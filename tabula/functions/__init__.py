"""Column expressions: scalars, row-wise statistics, aggregate bundles, selectors."""

from tabula.functions.scalars import (  # noqa: F401
    clamp0, cut_labels, cut_right_closed, days_since, flag, ieee_divide, is_non_finite,
    non_finite_to_null, null_if, power, safe_log1p, safe_sqrt, sig_round,
)
from tabula.functions.rowwise import (  # noqa: F401
    row_kurtosis, row_mean, row_median, row_null_count, row_sd, row_sum,
)
from tabula.functions.aggregates import BUNDLES, agg_expr, bundle_exprs, register  # noqa: F401
from tabula.functions.columns import (  # noqa: F401
    column_difference, columns_of_type, exclude, map_columns, map_floating, numeric_columns,
    prefix_rename, regex_columns, string_columns,
)
