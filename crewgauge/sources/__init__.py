"""Inputs: the three bronze frames and where they come from."""

from crewgauge.sources.bronze import Bronze

__all__ = ["Bronze"]
