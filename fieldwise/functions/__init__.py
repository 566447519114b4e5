"""fieldwise.functions."""
