"""seriesrel.operators."""
