"""Print the formatted physical plan of registered queries (no execution):
python scripts/explain.py [sf_dir] name [name ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from specimen.plans import queries as Q  # noqa: E402
from specimen.session import get_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1]
    spark = get_session("explain")
    for name in sys.argv[2:]:
        print(f"===== {name}")
        Q.QUERIES[name](spark, sf).explain("formatted")
