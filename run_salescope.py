"""spark-submit entry point: ``spark-submit run_salescope.py --help``."""

from salescope.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
