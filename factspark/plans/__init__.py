"""Whole runs, and the checked queries over the test tables."""
