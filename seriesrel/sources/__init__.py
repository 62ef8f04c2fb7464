"""seriesrel.sources."""
