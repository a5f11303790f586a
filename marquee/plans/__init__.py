"""Pipelines and reports."""
