"""Features, models and their metrics."""
