"""A load group's run: steps in order, gated by configuration, objects side by side, stopping at the first failure."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from lakeplane.naming import utc_now
from lakeplane.plans import workers
from lakeplane.plans.workers import Context, ModelQuery

# The steps of a run, in order.
STEPS = ("metadata", "bronze", "silver", "history", "gold", "pbi")
#: Objects that are loaded at once.
WIDTH = 3


def plan(ctx: Context, load_group: int, kind: str) -> object:
    """Work list of a kind: objects, models, datasets, steps or history."""
    kinds = {"objects": ctx.config.objects, "models": ctx.config.models, "datasets": ctx.config.datasets, "steps": ctx.config.steps, "history": ctx.config.history}
    if kind not in kinds:
        raise ValueError(f"unknown plan {kind!r}; known: {sorted(kinds)}")
    return kinds[kind](load_group)


def for_each(ctx: Context, items: list, work: Callable[[Mapping[str, object]], object], width: int = WIDTH) -> list:
    """Work on items side by side, each in a scheduler pool of its own; the first error is raised after all have ended."""

    def one(item: Mapping[str, object]) -> object:
        ctx.spark.sparkContext.setLocalProperty("spark.scheduler.pool", str(item.get("object_id")))
        try:
            return work(item)
        finally:
            ctx.spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(width) as pool:
        futures = [pool.submit(one, i) for i in items]
    return [f.result() for f in futures]


def run(ctx: Context, load_group: int, queries: Mapping[str, ModelQuery] | None = None, run_id: str | None = None, refresh: Callable[[Mapping[str, object]], None] | None = None) -> str:
    """Run a load group. ``refresh`` is called for each dataset of the last step."""
    run_id = run_id or f"run_{utc_now():%Y%m%d%H%M%S}_{load_group}"
    ctx.audit.create_tables()
    ctx.audit.start_run(run_id, {"load_group": load_group})
    active = ctx.config.steps(load_group)
    work = {
        "metadata": lambda: workers.metadata(ctx, load_group, run_id),
        "bronze": lambda: for_each(ctx, ctx.config.objects(load_group), lambda o: workers.bronze(ctx, o, run_id)),
        "silver": lambda: for_each(ctx, ctx.config.objects(load_group), lambda o: workers.silver(ctx, o, run_id)),
        "history": lambda: for_each(ctx, ctx.config.history(load_group), lambda o: workers.history(ctx, o, run_id)),
        "gold": lambda: [workers.gold(ctx, m["model_id"], run_id, queries or {}) for m in ctx.config.models(load_group)],
        "pbi": lambda: [refresh(d) for d in ctx.config.datasets(load_group) if refresh],
    }
    for step in STEPS:
        if not active.get(step, False):
            continue
        try:
            work[step]()
        except Exception as e:
            ctx.audit.log_failure("main", run_id, load_group, step, e)
            ctx.audit.finish_run(run_id, "FAILED", {"step": step})
            raise
    ctx.audit.finish_run(run_id)
    return run_id
