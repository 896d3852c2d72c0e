"""Composite data operations; every function is DataFrame -> DataFrame."""
