"""Whole jobs put together from the operators, one per packet family."""
