"""Reading, writing and reconciling tables."""
