"""Keyed tables by append and fold, for catalogs without row-level changes.

Each batch of changes is appended to a folder of its own, so a batch writes what it brings and no more.
Readers take the newest change of each key. Now and then a batch job folds what was appended into a
new base. Which changes win is decided by their order alone, so it does not matter whether a batch was
delivered twice or when a fold ran, nor, without epochs, in which order batches were appended.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import latest_across_epochs, latest_changes, live_rows
from tidemark.sources.files import MetadataFolder, delete_folder, finished_folders, is_finished

DEFAULT_WRITER = "default"


class ChangeTable:
    """Table with one current row per key below ``path``.

    ``order_cols`` decide between the changes of a key, ``epoch`` (the columns of epoch and time) says where they
    may be compared; rows without a key are ignored. A batch folder is read once Spark has marked it
    as finished.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order_cols: Sequence[str],
        delete_col: str | None = None,
        parts: int = 1,
        epoch: tuple[str, str] | None = None,
    ):
        self._spark = spark
        self._path = path.rstrip("/")
        self._keys = list(keys)
        self._order = list(order_cols)
        self._delete_col = delete_col
        self._parts = parts
        self._epoch = epoch
        self._folds = MetadataFolder(spark, f"{self._path}/folds")

    def _latest(self, changes: DataFrame) -> DataFrame:
        if self._epoch:
            return latest_across_epochs(changes, self._keys, *self._epoch, self._order)
        return latest_changes(changes, self._keys, self._order)

    def _folder(self, batch: int, writer: str) -> str:
        return f"log/{writer}-{batch:012d}"

    def append(self, changes: DataFrame, batch: int, writer: str = DEFAULT_WRITER) -> bool:
        """Write one batch, reduced to one change per key; False if ``writer`` has written ``batch`` before.

        ``writer`` tells independent batch counters apart, such as two streams with different checkpoints.
        A batch that broke off is written again from its start.
        """
        folder = self._folder(batch, writer)
        fold = self._folds.latest()
        if (fold and folder in fold["batches"]) or is_finished(self._spark, f"{self._path}/{folder}"):
            return False
        self._latest(changes).hint("rebalance").write.mode("overwrite").parquet(f"{self._path}/{folder}")
        return True

    def _pending(self, fold: dict | None) -> list[str]:
        done = set(fold["batches"]) if fold else set()
        return [f"log/{name}" for name in finished_folders(self._spark, f"{self._path}/log") if f"log/{name}" not in done]

    def version(self) -> int | None:
        """Grows with every batch; None before the first one."""
        fold = self._folds.latest()
        applied = (fold["applied"] if fold else 0) + len(self._pending(fold))
        return applied - 1 if applied else None

    def _changes(self, fold: dict | None, pending: Sequence[str]) -> DataFrame:
        if not fold and not pending:
            raise FileNotFoundError(f"nothing was written to {self._path}")
        base = self._spark.read.parquet(f"{self._path}/{fold['base']}") if fold else None
        if not pending:
            return base
        # Batches may have more or fewer columns than those before.
        changes = self._spark.read.option("mergeSchema", True).parquet(*[f"{self._path}/{f}" for f in pending])
        if base is None:
            return self._latest(changes)
        # Only the rows of changed keys are compared; the others stay as they are.
        changed = changes.select(*self._keys).distinct()
        met = base.join(changed, self._keys, "left_semi").unionByName(changes, allowMissingColumns=True)
        others = base.join(changed, self._keys, "left_anti")
        return self._latest(met).unionByName(others, allowMissingColumns=True)

    def read(self, include_deleted: bool = False) -> DataFrame:
        """Current rows. Marked deletes are hidden unless asked for."""
        fold = self._folds.latest()
        state = self._changes(fold, self._pending(fold))
        return live_rows(state, self._delete_col) if self._delete_col and not include_deleted else state

    def fold(self) -> bool:
        """Write the current rows, deletes included, as the new base; False if nothing was appended since.

        What the fold before this one made superfluous is deleted: a reader has the time between two folds
        to finish. One fold runs at a time; streams may go on meanwhile.
        """
        fold = self._folds.latest()
        pending = self._pending(fold)
        if not pending:
            return False
        number = (self._folds.latest_number() or 0) + 1 if fold else 0
        base = f"base/{number:012d}-{uuid.uuid4().hex[:12]}"
        state = self._changes(fold, pending).repartition(self._parts, *[F.col(k) for k in self._keys])
        state.write.parquet(f"{self._path}/{base}")
        document = {
            "base": base,
            "applied": (fold["applied"] if fold else 0) + len(pending),
            "folded": pending,
            # Not to be read again: the batches in the base whose folders may still be there.
            "batches": [*pending, *(fold["folded"] if fold else [])],
            "old": [*([fold["base"]] if fold else []), *pending],
        }
        self._folds.write(number, document)
        for folder in fold["old"] if fold else []:
            delete_folder(self._spark, f"{self._path}/{folder}")
        return True
