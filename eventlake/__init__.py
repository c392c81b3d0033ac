"""Batch analytics over nested event logs, as DataFrame to DataFrame functions."""
