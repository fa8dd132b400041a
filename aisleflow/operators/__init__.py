"""Relational operators: pivots, baskets, text long form, model twins,
evaluation tables.  All take and return DataFrames."""
