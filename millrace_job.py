"""Entry script for spark-submit; the jobs are in ``millrace.cli``."""

from millrace.cli import main

if __name__ == "__main__":
    main()
