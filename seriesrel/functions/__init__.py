"""seriesrel.functions."""
