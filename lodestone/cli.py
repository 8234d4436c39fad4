"""Command line. Exit status 1 where there is nothing to work on, 2 where no run becomes champion.

``version``, ``prepare``, ``evaluate``, ``select``, ``register``, ``train``, ``serve``.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from pathlib import Path

from lodestone.config import Config, load_config, parse_overrides


def prepare(spark, config: Config, out: str) -> dict:
    """Load, validate, deduplicate, split, fingerprint and write; the three split tables and a summary."""
    from lodestone.operators import records as R
    from lodestone.session import materialize
    from lodestone.sources import files

    d = config.data
    kind = "parquet" if d.source.endswith(".parquet") else d.source_type
    raw = files.load_records(spark, d.source, kind, d.max_examples, split=d.split, seed=d.seed)
    judged = R.judged(raw, d)
    kept = judged.where("reason is null").drop("reason")
    R.assert_unique_ids(kept)
    split = materialize(R.assign_split(kept, d), "split")
    R.assert_disjoint(split)
    for name in R.SPLITS:
        split.where(split["split"] == name).drop("bucket", "split").write.mode("overwrite").parquet(f"{out}/{name}")
    summary = R.validation_summary(judged).first().asDict() | {"drops": {r["reason"]: r["n"] for r in R.drop_counts(judged).collect()}}
    summary |= {"splits": {r["split"]: r["n"] for r in R.split_sizes(split).collect()}, "content_hash": R.multiset_hash(split)[0]}
    files.write_json_report(summary, f"{out.removeprefix('file://')}/summary.json")
    return summary


def evaluate(spark, config: Config, predictions: str, out: str) -> dict:
    """Score a table of (run_id, _idx, instruction, prediction, reference[, latency_ms, completion_tokens]) and report it."""
    from lodestone.operators import evaluation as E
    from lodestone.operators import quality as Q
    from lodestone.report import samples_markdown
    from lodestone.session import materialize
    from lodestone.sources import files

    e = config.evaluation
    pairs = spark.read.parquet(predictions)
    scores = materialize(Q.scored(E.first_of_each(pairs, "run_id", e.max_eval_samples)), "scores")
    quality = Q.macro_means(scores, e.metrics, ("run_id",)).withColumnRenamed("n", "num_eval_examples")
    latency = E.latency_and_cost(pairs, "run_id", "latency_ms", "completion_tokens", e.gpu_hourly_usd) if "latency_ms" in pairs.columns else None
    rows = [r.asDict() for r in E.report("run_id", quality, latency).orderBy("run_id").collect()]
    chosen = Q.best_and_worst(scores.select("run_id", "_idx", e.primary_metric), "run_id", e.primary_metric)
    samples = chosen.join(scores.select("run_id", "_idx", "instruction", "reference", "prediction"), ["run_id", "_idx"])
    files.write_json_report(rows, f"{out}/evaluation_report.json")
    Path(f"{out}/samples.md").write_text(samples_markdown(samples, e.primary_metric), encoding="utf-8")
    return {"runs": rows}


def select(spark, config: Config, source: str, out: str | None) -> int:
    from lodestone.operators.selection import candidates, ranked
    from lodestone.report import selection_markdown, selection_report
    from lodestone.sources.files import write_json_report

    c = candidates(spark.read.parquet(source))
    if c.isEmpty():
        print(f"no candidate runs in {source}")
        return 1
    print(selection_markdown(c, config.selection))
    if out:
        write_json_report(selection_report(c, config.selection), f"{out}/selection.json")
    return 2 if ranked(c, config.selection).isEmpty() else 0


def register(spark, config: Config, source: str, store: str, dry_run: bool) -> int:
    """Select, then promote the champion (and the runner-up) in the registry."""
    from lodestone.operators.runs import Store
    from lodestone.operators.selection import candidates, ranked

    top = {r["rank"]: r["run_id"] for r in ranked(candidates(spark.read.parquet(source)), config.selection).where("rank <= 2").collect()}
    if not top:
        print("no run passed the gates: nothing registered")
        return 2
    name = config.tracking.registered_model_name
    version = Store(spark, store).promote(name, top[1], top.get(2), dry_run)
    print(f"{top[1]} would be registered as {name}" if version is None else f"{top[1]} is {name} version {version}")
    return 0


def train(config: Config, function: str) -> int:
    """Run ``module:function(config)`` on the workers; needs torch."""
    from lodestone.operators.evaluation import train as run
    from lodestone.operators.runs import seed_everything

    module, _, name = function.partition(":")
    seed_everything(config.seed)
    print(run(getattr(importlib.import_module(module), name), config=config))
    return 0


def serve(port: int) -> int:
    """A server of canned answers, for testing clients; models are served elsewhere."""
    from lodestone.serving import run

    run(port)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestone")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("version", help="print the version")
    helps = {"prepare": "records to splits", "evaluate": "score predictions", "select": "rank runs", "register": "promote the champion", "train": "run a training function"}
    for name, text in helps.items():
        s = sub.add_parser(name, help=text)
        s.add_argument("--config", help="settings file")
        s.add_argument("--set", default="", help="a.b=1,c=x")
        if name == "train":
            s.add_argument("--function", required=True, help="module:function")
        else:
            s.add_argument("--input", required=True, help="table or file")
            s.add_argument("--out", help="folder for results")
        if name == "register":
            s.add_argument("--store", required=True, help="folder of the run store")
            s.add_argument("--dry-run", action="store_true")
    sub.add_parser("serve", help="answer requests without a model").add_argument("--port", type=int, default=8000)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "version":
        print("lodestone 0.2")
        return 0
    if a.command == "serve":
        return serve(a.port)
    given = parse_overrides(a.set)
    if a.command == "prepare":
        given["data.source"] = a.input
    config = load_config(a.config, given)
    if a.command == "train":
        return train(config, a.function)
    from lodestone.session import get_spark

    spark = get_spark()
    if a.command == "prepare":
        print(json.dumps(prepare(spark, config, a.out or config.data.local_dir), default=str))
        return 0
    if a.command == "evaluate":
        print(json.dumps(evaluate(spark, config, a.input, a.out or "out"), default=str))
        return 0
    return select(spark, config, a.input, a.out) if a.command == "select" else register(spark, config, a.input, a.store, a.dry_run)


if __name__ == "__main__":
    sys.exit(main())
