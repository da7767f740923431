"""Operators: each is DataFrame -> DataFrame or a fit/transform pair."""
