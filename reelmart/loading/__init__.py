"""Periods, output tables and the incremental run."""
