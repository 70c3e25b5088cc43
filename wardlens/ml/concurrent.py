"""Independent pieces of Spark work side by side, from a bounded pool of driver threads."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

K = TypeVar("K", bound=Hashable)
V = TypeVar("V")
MOST_THREADS = 16  # of one call; a fit of few rows waits for the driver about as long as it computes


def run_all(spark: SparkSession, work: Mapping[K, Callable[[], V]], threads: int = MOST_THREADS) -> dict[K, V]:
    """The results by name, all or an error.

    A short pass over few rows fills one core, so fits run next to each other. Each piece has a scheduler pool of its own:
    with ``spark.scheduler.mode=FAIR`` the pieces share the cores evenly, otherwise later ones take what the first leave.
    After a failure no further piece starts, and the error is raised once the running ones have ended.
    """
    sc = spark.sparkContext

    def pooled(number: int, piece: Callable[[], V]) -> Callable[[], V]:
        def target() -> V:
            sc.setLocalProperty("spark.scheduler.pool", f"piece-{number}")
            try:
                return piece()
            finally:
                sc.setLocalProperty("spark.scheduler.pool", None)

        return inheritable_thread_target(spark)(target)

    with ThreadPoolExecutor(max(1, min(threads, len(work)))) as pool:
        futures = {name: pool.submit(pooled(n, piece)) for n, (name, piece) in enumerate(work.items())}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = [f for f in done if f.exception() is not None]
        if failed:
            for future in futures.values():
                future.cancel()
            raise failed[0].exception()
    return {name: future.result() for name, future in futures.items()}
