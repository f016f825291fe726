"""Structured Streaming entry point for newly landed portfolio files."""

from .landing import landed_files, portfolio_batch, run_landed_files  # noqa: F401
