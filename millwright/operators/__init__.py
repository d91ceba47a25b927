"""Dataflow operators over DataFrames."""
