"""DataFrame -> DataFrame operators."""

from parcelmart.operators.relational import (
    anti,
    bucketize,
    conditional_sum,
    mark_hits,
    max_per_key,
    top1_per_group,
    union_distinct,
)

__all__ = ["anti", "bucketize", "conditional_sum", "mark_hits", "max_per_key", "top1_per_group", "union_distinct"]
