"""Policies, salts, options and whole-dataset jobs."""
