"""Operators and pipeline for building training data."""
