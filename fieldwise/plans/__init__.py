"""fieldwise.plans."""
