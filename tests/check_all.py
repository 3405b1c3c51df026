"""Compare every registered query with its SQL: ``python -m tests.check_all [sf] [name ...]``.

``CHECK_ZONE=America/New_York`` runs in a session with default settings in that zone.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from meterlake.session import local_session
from tests.compare import connect, difference


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    zone = os.environ.get("CHECK_ZONE")
    if zone:
        builder = SparkSession.builder.master("local[8]").config("spark.sql.session.timeZone", zone)
        spark = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = local_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not sys.argv[2:] or any(n.startswith(p) for p in sys.argv[2:])]
    failed = []
    for name in names:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
            else:
                problem, n = None, df.count()
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        if problem or n == 0:
            failed.append(name)
        note = problem or ("EMPTY" if n == 0 else "" if name in oracles else "no sql")
        print(f"{'FAIL' if problem or n == 0 else 'ok':4} {name:28} {n:7} rows {time.time() - began:6.2f}s {note}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
