"""Registered queries, their SQL checks, daily jobs and model training."""
