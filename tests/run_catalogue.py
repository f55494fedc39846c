"""python -m tests.run_catalogue SF_DIR [name...]: compare and time named queries."""

from __future__ import annotations

import sys
import time
import traceback

from corpuskit.catalogue import ORACLES, QUERIES
from corpuskit.session import local_session
from tests.compare import difference, duck


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                verdict = difference(spark, con, sf, QUERIES[name], ORACLES[name]) or "ok"
            else:
                verdict = f"rows {QUERIES[name](spark, sf).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += verdict != "ok" and not verdict.startswith("rows ")
        print(f"{name:28} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
