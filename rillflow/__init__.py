"""A PySpark-native clickstream lakehouse: classify, refine, model and report."""

from rillflow.context import RunContext
from rillflow.sources.lake import Lake

__all__ = ["Lake", "RunContext"]
