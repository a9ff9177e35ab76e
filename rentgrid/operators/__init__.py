"""Reusable DataFrame operators: quantiles, keys, checks, profiles, metrics."""
