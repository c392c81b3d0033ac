"""Incremental reading of raw files."""
