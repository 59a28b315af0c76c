"""One owner at a time, by numbered files: each number is a claim, a renewal or a release.

A claim has an owner and an end. Nobody else may claim before the end or the
release; after it anyone may, and of several one succeeds. The number serves as
a fence: whoever was taken over has a lower one and can no longer commit.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from cardlake.sources import numbered

SECONDS = 3600.0


class Held(RuntimeError):
    """Someone else holds the lease."""


class Lease:
    def __init__(self, spark: SparkSession, folder: str, owner: str, seconds: float = SECONDS):
        self.spark, self.folder, self.owner, self.seconds, self.number = spark, folder, owner, seconds, 0

    def claim(self, now: float | None = None) -> "Lease":
        now = time.time() if now is None else now
        number, said = numbered.newest(self.spark, self.folder)
        if said.get("until", 0) > now:
            raise Held(f"{self.folder} is held by {said['owner']}")
        self._write(number, now + self.seconds)
        return self

    def renew(self, now: float | None = None) -> None:
        """Hold on for another while; raises ``Held`` once someone has taken over."""
        number = numbered.newest(self.spark, self.folder)[0]
        if number != self.number:
            raise Held(f"{self.folder} has been taken over")
        self._write(number, (time.time() if now is None else now) + self.seconds)

    def release(self) -> None:
        if numbered.newest(self.spark, self.folder)[0] == self.number:
            self._write(self.number, 0)

    def _write(self, number: int, until: float) -> None:
        if not numbered.put(self.spark, self.folder, number + 1, {"owner": self.owner, "until": until}):
            raise Held(f"{self.folder} has just been claimed")
        self.number = number + 1
        if number > 2:  # only the newest number counts
            at, fs = numbered.file_system(self.spark, f"{self.folder}/{numbered.file_name(number - 2)}")
            fs.delete(at, False)


@contextmanager
def held(spark: SparkSession, folder: str, owner: str, seconds: float = SECONDS, wait: float = 0.0) -> Iterator[Lease]:
    """Claim, waiting at most ``wait`` seconds for another owner, and release at the end.

    A load that fails releases too: what it left unfinished is undone by the next.
    """
    own, until = Lease(spark, folder, owner, seconds), time.monotonic() + wait
    while True:
        try:
            own.claim()
            break
        except Held:
            if time.monotonic() >= until:
                raise
            time.sleep(0.2)
    try:
        yield own
    finally:
        own.release()
