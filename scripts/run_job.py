"""spark-submit entry point: ``spark-submit --py-files seriesrel.zip scripts/run_job.py <job> ...``."""

from seriesrel.__main__ import main

if __name__ == "__main__":
    main()
