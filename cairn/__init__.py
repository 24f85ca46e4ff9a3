"""Outdoor-data batch jobs on Spark: hiking trails with one day of weather, and
gear-brand mentions with season, category, context and sentiment."""

from cairn.plans.load import load_all, load_gear_reviews, load_trails
from cairn.plans.reviews import build_gear_reviews
from cairn.plans.trails import build_trails, trail_metrics
from cairn.sinks.tables import apply_ddl, init_tables

__all__ = [
    "apply_ddl",
    "build_gear_reviews",
    "build_trails",
    "init_tables",
    "load_all",
    "load_gear_reviews",
    "load_trails",
    "trail_metrics",
]
