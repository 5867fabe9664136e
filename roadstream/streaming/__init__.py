"""The three streaming jobs and their metrics."""
