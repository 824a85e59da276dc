"""Leakage-free customer signals as of a date, on Spark DataFrames."""

from tidemark.plans.feature_matrix import feature_matrix
from tidemark.plans.target import engagement_target
from tidemark.shop import Shop

__all__ = ["Shop", "engagement_target", "feature_matrix"]
