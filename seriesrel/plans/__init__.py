"""seriesrel.plans."""
