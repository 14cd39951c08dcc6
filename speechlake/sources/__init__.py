"""Readers: each returns a DataFrame with a fixed schema."""
