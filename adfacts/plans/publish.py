"""Outputs that replace earlier ones together, and only once all of them are there."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from adfacts.session import delete_folder, move_folder


class Publication:
    """Folders written beside their targets and renamed at the end.

    Within ``with Publication(spark, base) as out:`` an output is written to ``out.stage(suffix)``;
    it stands for ``base + suffix``. At the end, if nothing failed, the earlier folders are moved
    aside, the new ones take their names, and the earlier ones are deleted. If a rename fails, what
    was there before returns. After a failure within the block the earlier outputs are untouched.
    In every case the staging folder goes.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        parent, _, name = self.base.rpartition("/")
        self.folder = f"{parent + '/' if parent else ''}.{name}-{uuid.uuid4().hex}"
        self.suffixes: list[str] = []

    def stage(self, suffix: str = "") -> str:
        self.suffixes.append(suffix)
        return f"{self.folder}/new{suffix}"

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, failure: type | None, *_: object) -> None:
        try:
            if failure is None:
                self._publish()
        finally:
            delete_folder(self.spark, self.folder)

    def _publish(self) -> None:
        undo: list[Callable[[], bool]] = []

        def move(source: str, target: str) -> None:
            if move_folder(self.spark, source, target):
                undo.append(lambda: move_folder(self.spark, target, source))

        try:
            for suffix in self.suffixes:
                move(self.base + suffix, f"{self.folder}/old{suffix}")
                move(f"{self.folder}/new{suffix}", self.base + suffix)
        except Exception:
            for step in reversed(undo):
                step()
            raise
