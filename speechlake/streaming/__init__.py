"""Continuous jobs. Each has a batch twin whose rows it must reproduce."""
