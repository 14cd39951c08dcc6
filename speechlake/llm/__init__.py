"""Preparing text collections for model training: ten operators and their queries."""
