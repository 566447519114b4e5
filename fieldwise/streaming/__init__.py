"""fieldwise.streaming."""
