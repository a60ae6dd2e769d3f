"""Operators: DataFrame in, DataFrame out, no actions unless they say so."""
