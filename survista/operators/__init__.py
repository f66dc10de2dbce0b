"""DataFrame -> DataFrame operators."""

from .densify import densify, skeleton  # noqa: F401
from .eav import (attach_typed_values, decode_value, emit_scores, pivot_attributes,  # noqa: F401
                  pivot_from_metadata, safe_names)
from .filters import (active, branch_if, drop_in, keep_in, keep_levels, left_join_active,  # noqa: F401
                      optional_filter, restrict_to_user, years_in_window)
from .hierarchy import item_pct_of_sample, rollup_by, rollup_regroup  # noqa: F401
from .joins import (decode, drop_all_null, having_rows, join_left_residual, keep_answered, not_in)  # noqa: F401
from .measures import (any_match, count_where, dedupe, first_ordered, nonzero_mean, pct_gt_all, pct_met,  # noqa: F401
                       threshold_flag, yes_rate)
from .ranking import (both_ends, first_row, rank_global, roster_years, sort_totals_last, top_bottom,  # noqa: F401
                      top_bottom_join, top_n)
from .reshape import (borrow_rows, crosstab, crosstab_groups, pivot_first, union_sections, unpivot_facts,  # noqa: F401
                      wide_crosstab)
from .tree import attach_parent, flag_last, flatten_tree, sequence, sequence_by_expr  # noqa: F401
