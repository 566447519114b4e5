"""fieldwise.operators."""
