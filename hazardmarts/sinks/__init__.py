"""Published extracts and the run log."""
