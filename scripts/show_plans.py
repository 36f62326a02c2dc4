"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]   (default: the bench headline queries)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from wordlens.plans.queries import QUERIES  # noqa: E402
from wordlens.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = local_session(8)
    for name in names:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
