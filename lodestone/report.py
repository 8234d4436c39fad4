"""Reports for people: small collected frames formatted in Python, so that rounding is Python's."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame

from lodestone.config import SelectionConfig
from lodestone.operators.selection import status
from lodestone.sources.files import markdown_table

# Reports are for tables of runs; more rows than this are not formatted.
MAX_ROWS = 10_000


def _rows(df: DataFrame) -> list[dict]:
    rows = [r.asDict(recursive=True) for r in df.limit(MAX_ROWS + 1).collect()]
    if len(rows) > MAX_ROWS:
        raise ValueError("too many rows for a report")
    return rows


def reason_text(row: dict, baseline: dict | None, cfg: SelectionConfig) -> str:
    code = (row["rejected_reasons"] or [""])[0]
    if code == "is_baseline":
        return "the baseline"
    if code in ("quality_ratio", "not_above_baseline") and baseline and baseline["quality"]:
        share = row["quality"] / baseline["quality"]
        return f"quality {share:.1%} of baseline (< {cfg.min_quality_ratio_vs_baseline:.0%})" if code == "quality_ratio" else f"quality {row['quality']:.4f} does not beat the baseline"
    if code == "latency":
        return f"latency {row['latency_ms']:.0f}ms > {cfg.max_latency_ms:.0f}ms"
    if code == "memory":
        return f"memory {row['memory_mb']:.0f}MB > {cfg.max_memory_mb:.0f}MB"
    return code


def selection_markdown(candidates: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> str:
    rows = _rows(status(candidates, cfg))
    baseline = min((r for r in rows if r["is_baseline"]), key=lambda r: r["_idx"], default=None)
    rows.sort(key=lambda r: (r["rank"] is None, r["rank"] or 0, r["_idx"]))
    lines = []
    for r in rows:
        label = {"champion": "**champion**"}.get(r["status"], r["status"])
        if r["status"].startswith("rejected"):
            label = f"rejected ({reason_text(r, baseline, cfg)})"
        mark = " *" if r["on_pareto_frontier"] else ""
        lines.append((f"{r['run_name']}{mark}", r["method"], f"{r['quality']:.4f}", f"{r['latency_ms']:.0f} ms", f"{r['memory_mb']:.0f} MB", f"{r['model_size_mb']:.0f} MB", f"{r['utility']:.4f}", label))
    table = markdown_table(("Model", "Method", "Quality", "Latency p95", "Memory", "Size", "Utility", "Status"), lines)
    return table + "\n\n`*` marks runs that no other run dominates."


def selection_report(candidates: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> dict:
    """The decision as plain data: champion, ranked and rejected runs, the frontier, the weights."""
    rows = sorted(_rows(status(candidates, cfg)), key=lambda r: (r["rank"] is None, r["rank"] or 0, r["_idx"]))
    baseline = min((r for r in rows if r["is_baseline"]), key=lambda r: r["_idx"], default=None)
    for r in rows:
        r["reasons"] = [reason_text(r | {"rejected_reasons": [x]}, baseline, cfg) for x in r["rejected_reasons"]]
    ranked = [r for r in rows if r["rank"] is not None]
    front = sorted((r for r in rows if r["on_pareto_frontier"]), key=lambda r: (-r["quality"], r["_idx"]))
    return {
        "champion": ranked[0] if ranked else None, "challenger": ranked[1] if len(ranked) > 1 else None, "ranked": ranked, "rejected": [r for r in rows if r["rank"] is None],
        "pareto_frontier": [r["run_name"] for r in front], "weights": dict(cfg.weights),
    }


def tradeoff_markdown(report: dict) -> str:
    """The table of a written selection report, for people who ask why this run and not the best scored one."""
    runs = [*report.get("ranked", []), *report.get("rejected", [])]
    rows = [(r["run_name"], r["method"], f"{r['quality']:.4f}", f"{r['latency_ms']:.0f} ms", f"{r['memory_mb']:.0f} MB", f"{r['model_size_mb']:.0f} MB", f"{r['utility']:.4f}") for r in runs]
    chosen = report.get("champion") or {}
    weights = ", ".join(f"{k} {v}" for k, v in report.get("weights", {}).items())
    return "\n\n".join([f"Weights: {weights}", markdown_table(("Run", "Method", "Quality", "Latency p95", "Memory", "Size", "Utility"), rows), f"Champion: {chosen.get('run_name', 'none')}"])


def samples_markdown(samples: DataFrame, metric: str) -> str:
    out = ["# Samples", ""]
    for s in _rows(samples):
        out += [f"## [{s['bucket']}] score = {round(s[metric], 4)}", ""]
        for name in ("instruction", "reference", "prediction"):
            out += [f"**{name.title()}**", "", f"> {(s.get(name) or '')[:400]}", ""]
        out += ["---", ""]
    return "\n".join(out)


def model_card(run: dict, metrics: dict[str, float], dataset: dict, peers: DataFrame | None = None, cfg: SelectionConfig = SelectionConfig()) -> str:
    """A card of one run: what it is, how it was trained and on what, what was measured, why it was chosen, its limits."""
    params, tags = run.get("params") or {}, run.get("tags") or {}
    table = lambda pairs: markdown_table(("Field", "Value"), [(k, "-" if v is None else v) for k, v in pairs])
    number = lambda v: f"{v:.4f}" if isinstance(v, float) else str(v)
    groups = {"Quality": ("quality", "eval"), "Latency": ("latency",), "Memory": ("memory",), "Cost": ("cost",)}
    parts = [f"# {run['run_name']}", "", f"Written {datetime.now(UTC):%Y-%m-%d %H:%M UTC}.", ""]
    parts += ["## Model", "", table([(k, run.get(k) or params.get(k)) for k in ("run_id", "method", "base_model", "git_commit")] + sorted(tags.items())), ""]
    if params:
        parts += ["## Training", "", table((k, v) for k, v in sorted(params.items()) if k.startswith(("training.", "lora.", "quantization."))), ""]
    parts += ["## Data", "", table(sorted(dataset.items())), "", "## Measured", ""]
    rest = dict(sorted(metrics.items()))
    for title, prefixes in groups.items():
        own = {k: rest.pop(k) for k in list(rest) if k.partition("/")[0] in prefixes and "/" in k}
        if own:
            parts += [f"### {title}", "", markdown_table(("Metric", "Value"), [(k, number(v)) for k, v in own.items()]), ""]
    if rest:
        parts += [markdown_table(("Metric", "Value"), [(k, number(v)) for k, v in rest.items()]), ""]
    if peers is not None:
        parts += ["## Selection", "", f"Weights: {', '.join(f'{k} {v}' for k, v in cfg.weights.items())}.", "", selection_markdown(peers, cfg), ""]
    parts += ["## Limits", "", "Scores compare word overlap with one reference each. Latency and cost hold for the measured hardware and batch size. Answers can be wrong or unsafe; check them before use.", ""]
    return "\n".join(parts)
