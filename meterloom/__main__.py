"""Command line: the layers' drivers and the evaluation.

    python -m meterloom silver --manifest files.json --output silver --quarantine rejects
    python -m meterloom gold --silver silver --output gold
    python -m meterloom features --gold gold --output features
    python -m meterloom evaluate --features features --output-json report.json
    python -m meterloom audit --silver silver

A manifest is a JSON list of {"path": ..., "district": ..., "file_year": ...}.
"""

from __future__ import annotations

import argparse
import json

from .plans import pipelines
from .session import session
from .sources import read_parquet, shown


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="meterloom", description="Layers and reports of meter telemetry.")
    parser.add_argument("--master", help="Spark master; the cluster's own without it")
    steps = parser.add_subparsers(dest="step", required=True)
    wanted = {
        "silver": ("--manifest", "--output", "--quarantine"),
        "gold": ("--silver", "--output"),
        "features": ("--gold", "--output"),
        "evaluate": ("--features", "--output-json"),
        "audit": ("--silver",),
    }
    for name, options in wanted.items():
        step = steps.add_parser(name)
        for o in options:
            step.add_argument(o, required=o != "--output-json")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = _arguments(argv)
    spark = session(master=a.master)
    if a.step == "silver":
        with open(a.manifest, encoding="utf-8") as f:
            files = [({k: v for k, v in x.items() if k != "path"}, x["path"]) for x in json.load(f)]
        pipelines.build_silver(spark, files, a.output, a.quarantine)
    elif a.step == "gold":
        pipelines.build_gold(spark, a.silver, a.output)
    elif a.step == "features":
        print(shown(pipelines.build_features(spark, a.gold, a.output)))
    elif a.step == "evaluate":
        print(shown(pipelines.evaluate(spark, a.features, a.output_json)))
    else:
        rows = read_parquet(spark, a.silver)
        for kind, parts in {"audit": pipelines.audit(rows), "temporal": pipelines.temporal(rows), "resolution": pipelines.resolution(rows)}.items():
            for name, df in parts.items():
                print(f"{kind}: {name}")
                df.show(100, truncate=False)


if __name__ == "__main__":
    main()
