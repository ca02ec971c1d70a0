"""Composed jobs: the layer build and the set of serving queries."""
