"""seriesrel.streaming."""
