"""Whole jobs: dimensions, fact, cube and the analytical questions."""
