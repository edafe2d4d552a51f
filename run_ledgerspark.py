"""Entry script for ``spark-submit run_ledgerspark.py <command> ...``.

On a cluster ship the package with ``--py-files`` (a zip of ``ledgerspark``).
"""

import sys

from ledgerspark.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
