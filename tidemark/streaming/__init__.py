"""Jobs over unbounded input."""
