"""Whole jobs: frames to tables, and the analysis report."""
