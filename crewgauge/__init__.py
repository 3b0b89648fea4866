"""Workforce analytics on Spark: star schema, people measures and an attrition study."""

from crewgauge.params import Params

__all__ = ["Params"]
