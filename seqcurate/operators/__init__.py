"""Operators from DataFrame to DataFrame: selection, quotas, joins, k-mers, metrics."""
