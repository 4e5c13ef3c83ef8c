"""Reusable relational operators; the common ones are importable from here."""

from wardline.operators.audit import (
    audit_check,
    audit_decimal,
    audit_foreign_key,
    audit_length,
    audit_not_null,
    audit_primary_key,
    audit_unique,
)
from wardline.operators.hierarchy import CycleFound, ancestors, find_cycles
from wardline.operators.joins import anti_join, grid_join, interval_join, self_pairs
from wardline.operators.maintain import ForeignKey, assign_ids, propagate_delete, propagate_key_change
from wardline.operators.relate import (
    consecutive_equal,
    cross_overlap_pairs,
    distinct_counts,
    equal_measure_pairs,
    flag_any,
    gap_to_max,
    lookup,
    next_in_key,
    overlap_flags,
    overlap_pairs,
    pair_cooccurrence,
)
from wardline.operators.segments import ordered_parts

__all__ = [
    "CycleFound", "ForeignKey", "ancestors", "anti_join", "assign_ids", "audit_check",
    "audit_decimal", "audit_foreign_key", "audit_length", "audit_not_null", "audit_primary_key", "audit_unique",
    "consecutive_equal", "cross_overlap_pairs", "distinct_counts", "equal_measure_pairs", "find_cycles", "flag_any",
    "gap_to_max", "interval_join", "lookup", "next_in_key", "overlap_flags", "overlap_pairs", "pair_cooccurrence",
    "propagate_delete", "propagate_key_change", "self_pairs", 
]
