"""Several Spark jobs in flight from one driver, and the isolation of those that fail."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item, Result = TypeVar("Item"), TypeVar("Result")

#: Jobs that run at the same time, each in a scheduler pool of its own (which a FAIR scheduler shares the cluster between).
AT_ONCE = 8


def reason(error: BaseException) -> str:
    """The innermost cause of an error, in a line."""
    lines = [x.strip(" :\t") for x in str(error).splitlines() if x.strip() and not x.startswith("An error occurred while calling")]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    return f"{type(error).__name__}: {[*lines[:1], *causes][-1] if lines else ''}"[:600]


def run_all(spark: SparkSession, work: Sequence[Callable[[], Result]], at_once: int = AT_ONCE) -> list[Result | Exception]:
    """The results of ``work``, in order, with up to ``at_once`` calls in flight; an error is the result of its call.

    Threads take over the caller's local properties (job group, tags, description); pools are named ``concord-0`` and up.
    """
    sc = spark.sparkContext

    def prepared(place: int, call: Callable[[], Result]) -> Callable[[], Result | Exception]:
        @inheritable_thread_target(spark)  # in the caller's thread, whose properties it takes
        def run() -> Result | Exception:
            sc.setLocalProperty("spark.scheduler.pool", f"concord-{place % at_once}")
            try:
                return call()
            except Exception as e:  # noqa: BLE001 - reported by the caller
                return e

        return run

    calls = [prepared(i, call) for i, call in enumerate(work)]
    with ThreadPoolExecutor(max(1, min(at_once, len(work)))) as pool:
        return list(pool.map(lambda run: run(), calls))


def isolated(spark: SparkSession, items: Sequence[Item], run: Callable[[Sequence[Item]], Result], failed: Callable[[Item, Exception], Result],
             batch: int, at_once: int = AT_ONCE) -> list[Result]:
    """Results of ``run`` over batches of ``items``, several in flight. A batch that fails is halved until the failing items stand
    alone; those give ``failed(item, error)``. So no plan holds more than ``batch`` items, and one bad item costs
    log2(batch) further runs of its batch's halves."""
    todo = [list(items[a:a + batch]) for a in range(0, len(items), batch)]
    out: list[Result] = []
    while todo:
        again = []
        for part, result in zip(todo, run_all(spark, [lambda p=p: run(p) for p in todo], at_once)):
            if not isinstance(result, Exception):
                out.append(result)
            elif len(part) == 1:
                out.append(failed(part[0], result))
            else:
                again += [part[:len(part) // 2], part[len(part) // 2:]]
        todo = again
    return out
