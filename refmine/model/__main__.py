"""``python -m refmine.model -i contexts.json -o extractions.json -t topic``: the extraction stage alone."""

from __future__ import annotations

import sys

from refmine.__main__ import main

if __name__ == "__main__":
    sys.exit(main(["extract", *sys.argv[1:]]))
