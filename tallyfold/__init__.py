"""Compositional cohort analytics as Spark DataFrame jobs."""

from tallyfold.study import CLINICAL, Study

__all__ = ["CLINICAL", "Study"]
