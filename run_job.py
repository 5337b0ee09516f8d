"""spark-submit launcher: ``spark-submit --py-files reelhouse.zip run_job.py <job> [options]``."""

from reelhouse.jobs import main

if __name__ == "__main__":
    main()
