"""Panel analytics on Spark: roll-ups, leak-free features, labels, tiers and metrics."""

from weekloom.roles import Roles

__all__ = ["Roles"]
