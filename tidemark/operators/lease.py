"""A lease in shared storage, so that one writer works on a database at a time.

A lease is a folder of numbered files; the file of the highest number holds. Taking, renewing, taking over
what has run out and releasing all create the next number without overwriting, which storage grants to
one caller only. A holder that pauses too long finds its next number taken and knows that the lease is lost.
Only Hadoop's file systems are used; the storage must create files atomically, as HDFS does, and the writers'
clocks must agree to well under the time a lease lasts.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class LeaseLost(RuntimeError):
    """Another writer has taken the lease over."""


def _millis() -> int:
    return time.time_ns() // 1_000_000


class Lease:
    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        owner: str,
        seconds: int = 600,
        clock: Callable[[], int] = _millis,
    ):
        self.spark, self.folder, self.owner = spark, folder, owner
        self.millis, self.clock = 1000 * seconds, clock
        self.number: int | None = None  # of our own latest file
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(root)

    def _path(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number:012d}")

    def _numbers(self) -> dict[int, int]:
        """Numbers of the files, with the times they were written."""
        listed = self.files.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.folder))
        named = [(status.getPath().getName(), status.getModificationTime()) for status in listed]
        return {int(name): at for name, at in named if name.isdigit()}

    def _state(self) -> tuple[int, dict]:
        """The highest number, and who holds the lease until when."""
        numbers = self._numbers()
        if not numbers:
            return 0, {"owner": None, "until": 0}
        number = max(numbers)
        stream = self.files.open(self._path(number))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        # Created, but not written yet, or its writer was lost: its owner is unknown for as long as a lease lasts.
        return number, json.loads(text) if text else {"owner": "?", "until": numbers[number] + self.millis}

    def _put(self, number: int, owner: str | None, until: int) -> bool:
        """Create a file of that number, unless it or a higher one exists."""
        try:
            stream = self.files.create(self._path(number), False)
        except Py4JJavaError as problem:
            if "AlreadyExists" in str(problem.java_exception) or self.files.exists(self._path(number)):
                return False
            raise
        try:
            stream.write(json.dumps({"owner": owner, "until": until}).encode())
        finally:
            stream.close()
        numbers = self._numbers()
        if max(numbers) > number:
            # We looked so long ago that this number had come and gone.
            self.files.delete(self._path(number), False)
            return False
        for old in numbers:
            if old < number - 1:
                self.files.delete(self._path(old), False)
        return True

    def holder(self) -> str | None:
        _, state = self._state()
        return state["owner"] if state["until"] > self.clock() else None

    def acquire(self) -> bool:
        number, state = self._state()
        if state["until"] > self.clock():
            return False
        if not self._put(number + 1, self.owner, self.clock() + self.millis):
            return False
        self.number = number + 1
        return True

    def renew(self):
        if self.number is None or not self._put(self.number + 1, self.owner, self.clock() + self.millis):
            self.number = None
            raise LeaseLost(f"{self.owner}: the lease was taken over")
        self.number += 1

    def release(self):
        if self.number is not None:
            self._put(self.number + 1, None, 0)
            self.number = None

    @contextmanager
    def kept(self):
        """Renew the lease in the background, which was acquired before, and release it at the end.

        Raises ``LeaseLost`` at the end if another writer took it over meanwhile.
        """
        ended, lost = threading.Event(), []

        def keep():
            while not ended.wait(self.millis / 3000):
                try:
                    self.renew()
                except LeaseLost as problem:
                    lost.append(problem)
                    return

        keeper = threading.Thread(target=keep, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            ended.set()
            keeper.join()
            self.release()
        if lost:
            raise lost[0]
