"""fieldwise.sources."""
