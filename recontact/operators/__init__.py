"""Operators on DataFrames: suppression, one row per key, surveys, vouchers, ledger and delivery."""
