"""Readers: bar files, history tables, streams, prediction tables, configs."""
