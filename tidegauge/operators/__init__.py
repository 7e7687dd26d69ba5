"""Operators on measurements and transactions; each maps a DataFrame to a DataFrame."""
