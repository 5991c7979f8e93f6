"""Structured Streaming jobs: payload files to tables, and span files to the statement rollup."""
