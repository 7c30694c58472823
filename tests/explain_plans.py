"""Print the formatted physical plan of registered queries.

    python -m tests.explain_plans [sf_dir] [name ...]
"""

from __future__ import annotations

import sys


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from repolens.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session()
    qs = E.queries()
    for n in argv[1:] or sorted(qs):
        print(f"===== {n}")
        qs[n](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
