"""`python -m snapdiff <34 job arguments>`, or the same through spark-submit."""

from __future__ import annotations

import json
import sys
from datetime import datetime, timezone

from . import FeedSpec, build_session, run_job
from .functions.dates import run_timestamp


def main(argv: list[str]) -> None:
    spec = FeedSpec.from_args(argv)
    started = run_timestamp(datetime.now(timezone.utc))
    spark = build_session(f"delta processing - {spec.app_name}: {started}")
    try:
        print(json.dumps(run_job(spark, spec)))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
