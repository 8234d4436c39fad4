"""Running dependent steps on the driver, for instance: prepare, then every arm, then evaluation of all arms, then selection."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter
from typing import Any

log = logging.getLogger(__name__)
Step = tuple[Callable[[Mapping[str, Any]], Any], tuple[str, ...]]


def run(steps: Mapping[str, Step], parallel: int = 4) -> dict[str, Any]:
    """Results by name. A step gets the results so far and starts when all it waits for have ended.

    Independent steps run at the same time (Spark jobs of one session may). The first failure is raised after the steps
    that already run have ended; what depends on it is not started. Cycles and unknown names are errors.
    """
    if unknown := {d for _, needs in steps.values() for d in needs} - set(steps):
        raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
    order = TopologicalSorter({name: needs for name, (_, needs) in steps.items()})
    order.prepare()
    done: dict[str, Any] = {}
    running: dict[Future, str] = {}
    failed: BaseException | None = None
    with ThreadPoolExecutor(parallel) as pool:
        while running or (failed is None and order.is_active()):
            if failed is None:
                for name in order.get_ready():
                    log.info("start %s", name)
                    running[pool.submit(steps[name][0], dict(done))] = name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for f in ended:
                name = running.pop(f)
                if f.exception() is not None:
                    failed = failed or f.exception()
                    log.error("%s failed: %s", name, f.exception())
                else:
                    done[name] = f.result()
                    order.done(name)
    if failed is not None:
        raise failed
    return done
