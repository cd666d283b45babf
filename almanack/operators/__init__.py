"""Relational and learning operators the analyses are made of."""

from .aggregates import (
    argmax_by_key,
    argmax_row,
    having_min_counts,
    mean_where,
    rows_at_max,
    share_where,
)
from .clustering import assemble, assign_kmeans, fit_kmeans, nearest_center
from .joins import bounded_broadcast, contains_join, nested_pair_join, stored_dimension
from .moments import merge_moments, moments
from .ranking import first_rows, key_share, sample_by_key, with_positions
from .regression import amplitude, fit_plane, seasonal_amplitude

__all__ = [
    "amplitude",
    "argmax_by_key",
    "argmax_row",
    "assemble",
    "assign_kmeans",
    "bounded_broadcast",
    "contains_join",
    "first_rows",
    "fit_kmeans",
    "fit_plane",
    "having_min_counts",
    "key_share",
    "mean_where",
    "merge_moments",
    "moments",
    "nearest_center",
    "nested_pair_join",
    "rows_at_max",
    "sample_by_key",
    "seasonal_amplitude",
    "share_where",
    "stored_dimension",
    "with_positions",
]
