"""python tests/run_checks.py [scale factor] [name ..]: every query against its SQL, with times."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from oracle import check  # noqa: E402

from touchline.queries import ORACLES, QUERIES  # noqa: E402
from touchline.session import local_session  # noqa: E402

scale = sys.argv[1] if len(sys.argv) > 1 else "0.001"
names = sys.argv[2:] or list(QUERIES)
spark = local_session("checks")
bad = 0
for name in names:
    start = time.time()
    try:
        problems, rows = check(spark, name, f"/root/testdata/sf{scale}")
    except Exception as error:
        problems, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        if not str(error):
            traceback.print_exc()
    bad += bool(problems)
    kind = "sql " if name in ORACLES else "rows"
    print(f"{'FAIL' if problems else 'ok  '} {kind} {name:28s} {rows:8d} rows {time.time() - start:6.2f}s", flush=True)
    for p in problems:
        print("      ", p[:1500], flush=True)
print(f"{bad} of {len(names)} failed")
spark.stop()
