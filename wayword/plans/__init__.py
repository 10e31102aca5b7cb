"""Whole jobs from files to files, and the queries over the test tables."""
