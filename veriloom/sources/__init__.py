"""Reading, landing and merging tables."""
