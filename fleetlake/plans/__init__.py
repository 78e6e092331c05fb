"""Whole jobs, each one declarative query over the lake."""
