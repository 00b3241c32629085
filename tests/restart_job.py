"""One start of the enrichment job with ``restart``, in a process of its own: with a third
argument the process dies as soon as that output is written."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from joinery.plans import workflow  # noqa: E402
from joinery.session import local_session  # noqa: E402


def main(config: str, report: str, die_after: str = "") -> None:
    with open(config) as f:
        cfg = json.load(f)
    spark = local_session(2, app="restart", driver_memory="1g", **{"spark.checkpoint.dir": cfg.pop("checkpoint")})
    plain, made = workflow.write_version, []

    def write(df, base, name, *rest):
        row = plain(df, base, name, *rest)
        made.append(name)
        if name == die_after:
            os._exit(3)
        return row

    workflow.write_version = write
    written = workflow.run_enrichment(spark, cfg)
    with open(report, "w") as f:
        json.dump({"made": made, "written": written}, f)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
