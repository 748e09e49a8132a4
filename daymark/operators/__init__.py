from daymark.operators.aggregates import distinct_rows, labelled_sum
from daymark.operators.joins import Side, join_sources, split_left_join
from daymark.operators.latest import Group, latest_per_group, latest_per_key
from daymark.operators.snapshot import snapshot_at
from daymark.operators.unions import stack, union_distinct

__all__ = [
    "Group",
    "Side",
    "distinct_rows",
    "join_sources",
    "labelled_sum",
    "latest_per_group",
    "latest_per_key",
    "snapshot_at",
    "split_left_join",
    "stack",
    "union_distinct",
]
