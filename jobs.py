"""Entry script for spark-submit; see `python jobs.py --help`."""

from fareflow.__main__ import main

if __name__ == "__main__":
    main()
