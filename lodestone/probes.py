"""Measuring a callable on the driver: latency samples and memory, in the shape the summaries read."""

from __future__ import annotations

import gc
import resource
import time
import tracemalloc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

LATENCIES = "run_id string, i int, batch_size int, ms double, tokens bigint"


def synthetic_prompt(words: int) -> str:
    """A prompt of so many words, the same every time."""
    base = "Explain in plain words how a process works and why it matters".split()
    return " ".join(base[k % len(base)] for k in range(words))


def latencies(run_id: str, generate: Callable[[list[str]], int], prompt_tokens: int = 128, batches: tuple[int, ...] = (1,), warmup: int = 3, measured: int = 20, sync: Callable[[], None] = lambda: None) -> list[tuple]:
    """Rows of :data:`LATENCIES`: ``generate`` answers a batch of prompts and returns how many tokens it made.

    The first ``warmup`` calls of a batch size do not count. ``sync`` waits for a device to finish, so that a call's time
    is that of its work.
    """
    rows = []
    for size in batches:
        prompts = [synthetic_prompt(prompt_tokens)] * size
        for k in range(warmup + measured):
            sync()
            began = time.perf_counter()
            made = generate(prompts)
            sync()
            if k >= warmup:
                rows.append((run_id, k - warmup, size, (time.perf_counter() - began) * 1000.0, made))
    return rows


def host_mb() -> float:
    """Largest resident size of this process so far."""
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024


@contextmanager
def peak_memory() -> Iterator[dict[str, float]]:
    """Peak megabytes that Python allocated inside the block, and the host's; a failing block still reports them."""
    gc.collect()
    fresh = not tracemalloc.is_tracing()
    if fresh:
        tracemalloc.start()
    tracemalloc.reset_peak()
    found: dict[str, float] = {}
    try:
        yield found
    finally:
        found["peak_mb"] = tracemalloc.get_traced_memory()[1] / 1048576
        found["host_rss_mb"] = host_mb()
        if fresh:
            tracemalloc.stop()
