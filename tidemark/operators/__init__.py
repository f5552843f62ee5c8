"""Operators: data frames in, data frames out, plus the table writes built on them."""
