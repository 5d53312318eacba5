"""DataFrame -> DataFrame operators."""

from tidewater.operators.aggregates import distinct_counts, group_agg, numeric_sums, profile_table
from tidewater.operators.history import snapshot_merge
from tidewater.operators.relational import (branch_counts, exclude, exists_flag, folded_join, hop, keep_only,
                                            lookup_join, role_join)
from tidewater.operators.reshape import attribute_pivot, densify_sum, key_batches, month_spine, rollup_rows
from tidewater.operators.sets import name_difference, split_union, tagged_union, union_all
from tidewater.operators.versions import drop_earliest_dup, first_by, latest_by

__all__ = [
    "attribute_pivot", "branch_counts", "densify_sum", "distinct_counts", "drop_earliest_dup", "exclude", "exists_flag",
    "first_by", "folded_join", "group_agg", "hop", "keep_only", "key_batches", "latest_by", "lookup_join",
    "month_spine", "name_difference", "numeric_sums", "profile_table", "role_join", "rollup_rows",
    "snapshot_merge", "split_union", "tagged_union", "union_all",
]
