"""Print the physical plan of a registered query.

usage: python tools/explain.py NAME [sf_dir] [--static]
``--static`` turns AQE off so the whole plan (all exchanges, pushed filters,
read schemas) is shown before any stage runs.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelrep.plans import catalog  # noqa: E402
from panelrep.session import get_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    name = args[0]
    sf = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    catalog.stand_in(spark, sf).project  # materialize inputs first
    if "--static" in sys.argv:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    catalog.QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
