"""Relational operators, joins, and append, update, delete and merge."""

from kiln.operators.bucketed import bucketed_join, hot_keys
from kiln.operators.joins import cached, join_dimension, join_on_keys
from kiln.operators.relational import (
    count_distinct,
    distinct_values,
    first_row,
    global_stats,
    group_count,
    group_sum,
    pivot_agg,
    sort_spread,
    top_k,
    top_k_per_group,
    top_values_per_group,
    union_all,
)
from kiln.operators.partitioned import delete_files, merge_files, read_partitioned, update_files, write_partitioned
from kiln.operators.tables import SchemaMismatchError, append, append_files, check_schema, delete, merge, stored_schema, update

__all__ = [
    "bucketed_join", "hot_keys", "cached", "join_dimension", "join_on_keys",
    "count_distinct", "distinct_values", "first_row", "global_stats", "group_count", "group_sum",
    "pivot_agg", "sort_spread", "top_k", "top_k_per_group", "top_values_per_group", "union_all",
    "delete_files", "merge_files", "read_partitioned", "update_files", "write_partitioned",
    "SchemaMismatchError", "append", "append_files", "check_schema", "delete", "merge", "stored_schema", "update",
]
