"""Places in a total order, without sorting a group in one task: those of the main library."""

from tapeworks.functions.scans import numbered

__all__ = ["numbered"]
