"""Launcher for spark-submit: ``spark-submit --py-files tagloom.zip tagloom_job.py build ...``
(the same commands as ``python -m tagloom``)."""

import sys

from tagloom.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
