"""Questions asked of the tables."""
