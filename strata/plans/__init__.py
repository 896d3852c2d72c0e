"""Proof plans: each builds one DataFrame from the driver tables with library functions."""
