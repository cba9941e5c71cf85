"""Composed plans: the refresh pipeline and the registered per-operator queries."""
