"""Composed jobs: the full transformation, the run, and the test-table queries."""
