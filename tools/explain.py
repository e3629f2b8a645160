"""Print the physical plan of registered queries: python tools/explain.py [sf_dir] key [mode]"""

import sys

sys.path.insert(0, ".")

from faresight.plans.queries import QUERIES  # noqa: E402
from faresight.session import get_session  # noqa: E402

args = sys.argv[1:]
sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
key = args[0]
mode = args[1] if len(args) > 1 else "formatted"
spark = get_session("local[8]", 16)
QUERIES[key](spark, sf).explain(mode)
