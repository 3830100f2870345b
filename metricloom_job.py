"""Starts the command line of the jobs from wherever it is called; executors need no copy of the package."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricloom.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
