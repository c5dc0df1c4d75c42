"""Whole runs: build the summaries, keep the history, publish the views."""
