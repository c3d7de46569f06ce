"""Whole jobs and the checked queries."""
