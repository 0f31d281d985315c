"""Whole runs: loading the target tables and billing a month."""
