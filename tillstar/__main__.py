"""`python -m tillstar job.json`, or the same through spark-submit.

The job file holds `databases` (reader options by name), `sources` (see
`plans.run.read_raw`, one entry per raw table), `out`, and optionally `strict`.
Passwords and keys do not belong into it: `$NAME` in any text is taken from the
environment.
"""

import json
import os
import sys
from typing import Any

from .plans.run import run
from .session import build_session
from .sources import SourceRegistry


def expand(value: Any) -> Any:
    """`value` with environment variables put into its texts."""
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v) for v in value]
    return os.path.expandvars(value) if isinstance(value, str) else value


def main(path: str) -> None:
    with open(path) as file:
        job = expand(json.load(file))
    registry = SourceRegistry(job.get("databases", {}))
    run(build_session(), registry, job["sources"], job["out"], job.get("strict", False))


if __name__ == "__main__":
    main(sys.argv[1])
