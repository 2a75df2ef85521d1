"""Preparation of time-ordered episode data, and of training text, on Spark."""
