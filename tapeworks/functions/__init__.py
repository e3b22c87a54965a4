"""Part of tapeworks."""
