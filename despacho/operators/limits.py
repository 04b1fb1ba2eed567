"""A time limit on the Spark work of a block."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

QUERY_SECONDS = 3600.0  # fixed value: the source's limit on a query


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Cancel the jobs that the block runs in this thread once ``seconds`` are over, and raise ``TimeoutError``.

    A block that is between two jobs then has its next ones cancelled too. Jobs of
    other threads go on.
    """
    if seconds is None:
        yield
        return
    context, tag, over = spark.sparkContext, f"limit-{uuid.uuid4().hex}", threading.Event()
    ended = threading.Event()

    def stop() -> None:
        over.set()
        # Again and again, as the block may begin another job after one was cancelled.
        while not ended.is_set():
            context.cancelJobsWithTag(tag)
            ended.wait(1.0)

    timer = threading.Timer(seconds, stop)
    timer.daemon = True
    context.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimeoutError(f"not done within {seconds:g} seconds") from error
        raise
    finally:
        ended.set()
        timer.cancel()
        context.removeJobTag(tag)
    if over.is_set():
        raise TimeoutError(f"not done within {seconds:g} seconds")
