"""Command line: ``python -m tidemark.cli run | check-setup | status``."""

from __future__ import annotations

import argparse
import importlib.util
import platform
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.config import SCALES, Layers
from tidemark.operators.clustering import ThemeClusterer
from tidemark.operators.embedding import HASHING_MODEL, local_encoder
from tidemark.operators.explanations import MAX_EXPLANATIONS, SYSTEM_PROMPT
from tidemark.plans import stages
from tidemark.schemas import GOLD_TABLES
from tidemark.session import build_session, hadoop_path, path_exists, ship_package
from tidemark.sources import gold_layer
from tidemark.sources.archive import read_zip_json
from tidemark.sources.http import HttpClient
from tidemark.sources.lists import cik_list, read_overrides
from tidemark.sources.text_service import TextService, generator

STAGES = ("ingestion", "parsing", "nlp", "drift", "explain", "gold")
DEPENDENCIES = ("pyspark", "pyarrow", "pandas", "numpy")


def format_duration(seconds: float) -> str:
    """``12.3s`` below a minute, else ``3m05s``."""
    if seconds < 60:
        return f"{seconds:.1f}s"
    minutes, rest = divmod(int(seconds), 60)
    return f"{minutes}m{rest:02d}s"


@dataclass
class StageResult:
    stage: str
    status: str
    seconds: float | None = None
    metrics: dict = field(default_factory=dict)


def run_stages(
    plan: dict[str, Callable[[], dict]], skipped: set[str], report=print
) -> list[StageResult]:
    """Run the stages in order; the first failure ends the run."""
    results: list[StageResult] = []
    for name, work in plan.items():
        if name in skipped:
            results.append(StageResult(name, "skipped"))
            continue
        begin = time.monotonic()
        try:
            metrics = work()
        except Exception as error:  # the summary must show the failed stage
            report(f"stage '{name}' failed: {error}")
            results.append(StageResult(name, "error", time.monotonic() - begin))
            return results
        results.append(StageResult(name, "ok", time.monotonic() - begin, metrics))
    return results


def summary(results: list[StageResult]) -> str:
    lines = [f"{'stage':<12}{'status':<10}{'time':>8}  metrics"]
    for r in results:
        spent = "-" if r.seconds is None else format_duration(r.seconds)
        shown = ", ".join(f"{k}={v}" for k, v in r.metrics.items())
        lines.append(f"{r.stage:<12}{r.status:<10}{spent:>8}  {shown}")
    return "\n".join(lines)


def _run(args: argparse.Namespace, spark: SparkSession) -> int:
    ship_package(spark)
    layers = Layers(args.base)
    scale = SCALES[args.scale]
    skipped = {s for s in STAGES if getattr(args, f"skip_{s}")}
    agent = args.user_agent

    def ingestion() -> dict:
        if not args.submissions or not agent:
            raise ValueError("ingestion needs --submissions ARCHIVE and --user-agent")
        ciks = cik_list(spark, args.scale, args.companies)
        return stages.ingest(
            spark, layers, read_zip_json(spark, args.submissions), ciks, list(scale.years),
            lambda interval: HttpClient(agent, interval), scale.tasks,
        )

    service = TextService()
    available = not args.no_text_service and service.is_available()
    explain_with = generator(TextService, SYSTEM_PROMPT) if available else None
    label_with = generator(TextService, key="cluster_id", output="raw_label") if available else None
    plan = {
        "ingestion": ingestion,
        "parsing": lambda: stages.parse(spark, layers),
        "nlp": lambda: stages.understand(
            spark,
            layers,
            ThemeClusterer.for_scale(args.scale, k=args.themes, noise_ratio=args.noise_ratio),
            encode=local_encoder(args.encoder, args.encoder_folder) if args.encoder else None,
            overrides=read_overrides(spark, layers.overrides),
            generate=label_with,
            model=f"{args.encoder} {args.encoder_folder or ''}".strip() if args.encoder else HASHING_MODEL,
        ),
        "drift": lambda: stages.drift(spark, layers),
        "explain": lambda: stages.explain(
            spark, layers, args.max_explanations, explain_with, service.model
        ),
        "gold": lambda: stages.publish(spark, layers),
    }
    results = run_stages(plan, skipped)
    print(summary(results))
    return int(any(r.status == "error" for r in results))


def check_setup(base: str, spark: SparkSession) -> dict[str, bool]:
    """Python, packages, text service and layer folders."""
    checks = {f"python {platform.python_version()} >= 3.10": sys.version_info >= (3, 10)}
    for name in DEPENDENCIES:
        checks[f"package {name}"] = importlib.util.find_spec(name) is not None
    checks["text service (optional)"] = TextService(timeout=2).is_available()
    for layer in ("bronze", "silver", "gold"):
        checks[f"folder {layer}"] = path_exists(spark, f"{base}/{layer}")
    return checks


def layer_status(spark: SparkSession, base: str) -> dict[str, dict]:
    """Files and bytes per layer, rows and columns per gold table."""
    found: dict[str, dict] = {}
    for layer in ("bronze", "silver", "gold"):
        target, fs = hadoop_path(spark, f"{base}/{layer}")
        if fs.exists(target):
            content = fs.getContentSummary(target)
            found[layer] = {
                "files": content.getFileCount(),
                "bytes": content.getLength(),
                "entries": len(fs.listStatus(target)),
                "newest": max((s.getModificationTime() for s in fs.listStatus(target)), default=0),
            }
    gold = Layers(base).gold
    for name in GOLD_TABLES:
        if gold_layer.table_exists(spark, gold, name):
            table = gold_layer.read_table(spark, gold, name)
            rows = table.agg(F.count(F.lit(1))).first()[0]
            found[f"gold.{name}"] = {"rows": rows, "columns": len(table.columns)}
    return found


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    top.add_argument("--base", default="data", help="folder of the data layers")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the stages in order")
    run.add_argument("--scale", choices=list(SCALES), default="small")
    run.add_argument("--companies", help="file with one entity key per line")
    run.add_argument("--submissions", help="bulk archive of submissions")
    run.add_argument("--user-agent", help="identifies the caller to the archive")
    run.add_argument("--themes", type=int, help="number of themes; found from the data if left out")
    run.add_argument("--noise-ratio", type=float, default=ThemeClusterer.noise_ratio)
    run.add_argument("--encoder", help="module:function that loads the text encoder; term hashing if left out")
    run.add_argument("--encoder-folder", help="folder that the encoder's function gets, such as its weights")
    run.add_argument("--max-explanations", type=int, default=MAX_EXPLANATIONS)
    run.add_argument("--no-text-service", action="store_true")
    for stage in STAGES:
        run.add_argument(f"--skip-{stage}", action="store_true")
    commands.add_parser("check-setup", help="check packages and folders")
    commands.add_parser("status", help="show what the layers hold")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or build_session()
    if args.command == "run":
        return _run(args, session)
    if args.command == "check-setup":
        checks = check_setup(args.base, session)
        for name, ok in checks.items():
            print(f"{'ok  ' if ok else 'MISS'} {name}")
        needed = [ok for name, ok in checks.items() if name.startswith(("python", "package"))]
        return int(not all(needed))
    for name, figures in layer_status(session, args.base).items():
        print(name, figures)
    return 0


if __name__ == "__main__":
    sys.exit(main())
