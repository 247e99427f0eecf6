"""Build every layer of the lakehouse from one test-table folder into the
shared folder (``spark.checkpoint.dir``) and print the rows written.

    python scripts/run_layers.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.plans.layered import run_layers  # noqa: E402
from marquee.session import build_session, run_folder  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[*]", "marquee-layers")
    root = run_folder(spark, "lakehouse")
    for name, (layer, version, rows) in run_layers(spark, sf_dir, root).items():
        print(f"{layer:6s} {name:32s} v{version} rows={rows}")
    print("published under", root)


if __name__ == "__main__":
    main()
