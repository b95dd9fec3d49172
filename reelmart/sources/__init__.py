"""Inputs: catalog or Parquet tables, and an adapter over a star schema."""
