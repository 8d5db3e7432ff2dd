"""Tables that are published all at once: data folders written once, and a small pointer that names the current ones.

    <root>/data/batch=<name>/[<partition>=<value>/]part-*.parquet
    <root>/versions/<number>.json

A batch writes the new rows of the partitions it touches to a folder of its own.  The pointer, written last and under a
new number, says for each partition which batch holds it.  Readers resolve the newest pointer first, so
they see a batch whole or not at all, and a version they have resolved stays as it is while others publish.  Rolling
back publishes an earlier pointer again.  Two writers that start from the same version can't both publish: the second
finds its number taken.

The pointer has one entry per partition (dates: some thousands); rows, files and statistics stay Parquet's business.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from berthline.operators.interleave import interleaved
from berthline.session import delete_path, list_names, path_exists, read_small, scratch_dir, stored, write_new

DIGITS = 10
# Labels of published batches that a pointer remembers, newest last.
RECENT = 100


class PublishConflict(RuntimeError):
    """Another writer published since the version that a batch started from."""


@dataclass(frozen=True)
class Pointer:
    """What a version holds: partition folder (empty without partitions) to batch name."""

    version: int
    folders: dict[str, str]
    recent: tuple[str, ...] = ()
    schema: str | None = None
    notes: dict[str, object] = field(default_factory=dict)


class VersionedTable:
    """A Parquet table below `root`, whole or partitioned by one column.

    `schema` may be left out where the table exists: the pointer has it.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, partition: str | None = None):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition
        self._schema = schema

    # --- pointers -----------------------------------------------------------------

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.root}/versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _path(self, version: int) -> str:
        return f"{self.root}/versions/{version:0{DIGITS}d}.json"

    def pointer(self, version: int | None = None) -> Pointer:
        """The given version, or the newest; version 0 is the empty table."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Pointer(0, {})
        return Pointer(version, **json.loads(read_small(self.spark, self._path(version))))

    def schema(self, pointer: Pointer | None = None) -> T.StructType:
        if self._schema is None:
            told = (pointer or self.pointer()).schema
            if told is None:
                raise ValueError(f"no table at {self.root}: give its schema")
            self._schema = T.StructType.fromJson(json.loads(told))
        return self._schema

    def published(self, label: str) -> bool:
        """Whether one of the last RECENT labelled batches bears the label; rolled back ones count."""
        return label in self.pointer().recent

    def moved(self, since: int, until: int | None = None) -> list[str]:
        """Partitions whose folder differs between two versions."""
        before, after = self.pointer(since).folders, self.pointer(until).folders
        return sorted(p for p in before.keys() | after.keys() if before.get(p) != after.get(p))

    # --- reading ------------------------------------------------------------------

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """All rows of a version, or those of the named partitions."""
        pointer = self.pointer(version)
        folders = pointer.folders if parts is None else {p: pointer.folders[p] for p in parts if p in pointer.folders}
        return self._of(folders, self.schema(pointer))

    def _of(self, folders: dict[str, str], schema: T.StructType) -> DataFrame:
        """Rows of the named folders, with the partition column from the folder."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/batch={batch}/{part}".rstrip("/") for part, batch in sorted(folders.items())]
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*schema.fieldNames())

    def changes(self, keys: list[str], since: int, until: int | None = None) -> DataFrame:
        """(old, new): rows of version `since` and of version `until` that differ, matched by key; a missing image is null.

        Only the partitions whose folder differs between the two are read.  Keys are unique in a version; null keys are equal.
        """
        until = self.pointer(until).version
        moved, row = self.moved(since, until), F.struct(*self.schema(self.pointer(until)).fieldNames())
        sides = [self.read(v, moved).select(*keys, F.lit(v == until).alias("is_new"), row.alias("row")) for v in (since, until)]
        image = lambda new: F.max(F.when(F.col("is_new") == F.lit(new), F.col("row")))
        met = reduce(DataFrame.unionByName, sides).groupBy(*keys).agg(image(False).alias("old"), image(True).alias("new"))
        return met.filter(~F.col("old").eqNullSafe(F.col("new"))).select("old", "new")

    # --- writing ------------------------------------------------------------------

    def is_written(self, batch: str) -> bool:
        """Whether a batch's folder is whole: its writer's mark is there."""
        return path_exists(self.spark, f"{self.root}/data/batch={batch}/_SUCCESS")

    def write(
        self,
        rows: DataFrame,
        batch: str | None = None,
        order_by: list[Column | str] | None = None,
        cluster_by: list[str] | None = None,
        **options: object,
    ) -> str:
        """Write a batch's rows to a folder of its own; nobody reads it before `publish`.

        Without an order the rebalance hint lets AQE size the files: small partitions share a task, a hot one is
        split over several.  ``cluster_by`` lays the rows of each file in an order that lets filters on any of these
        columns skip row groups; such rows are stored first, as their order is made from them.
        """
        batch = batch or uuid.uuid4().hex
        rows = rows.select(*self._schema_of(rows).fieldNames())
        if order_by:
            rows = rows.orderBy(*order_by)
        elif cluster_by:
            rows = stored(rows, scratch_dir(self.spark, "unclustered"))
            place = interleaved(rows, cluster_by)
            dealt = rows.hint("rebalance", *([self.partition] if self.partition else []))
            rows = dealt.sortWithinPartitions(*([self.partition] if self.partition else []), place)
        elif self.partition:
            rows = rows.hint("rebalance", self.partition)
        out = rows.write.mode("overwrite").options(**options)
        (out.partitionBy(self.partition) if self.partition else out).parquet(f"{self.root}/data/batch={batch}")
        return batch

    def _schema_of(self, rows: DataFrame) -> T.StructType:
        if self._schema is None:
            self._schema = rows.schema
        return self._schema

    def publish(self, batch: str, base: int, touched: list[str] | None = None, label: str | None = None, **notes: object) -> int:
        """Make a written batch current: its partitions replace those of version `base`.

        `touched` names partitions that go even if the batch has no rows for them.
        """
        names = list_names(self.spark, f"{self.root}/data/batch={batch}")
        parts = [n for n in names if n.startswith(f"{self.partition}=")] if self.partition else [""]
        before = self.pointer(base)
        kept = {p: b for p, b in before.folders.items() if p not in (touched or ())}
        recent = [*before.recent, *([label] if label else [])][-RECENT:]
        return self._point(base + 1, kept | dict.fromkeys(parts, batch), recent, notes)

    def rollback(self, version: int, **notes: object) -> int:
        """Make an earlier version current again, under a new number."""
        now = self.pointer()
        return self._point(now.version + 1, self.pointer(version).folders, now.recent, {"rolled_back_to": version} | notes)

    def _point(self, version: int, folders: dict[str, str], recent: list[str], notes: dict) -> int:
        told = {"folders": dict(sorted(folders.items())), "recent": recent, "schema": self.schema().json(), "notes": notes}
        if not write_new(self.spark, self._path(version), json.dumps(told, indent=1)):
            raise PublishConflict(f"version {version} of {self.root} is there already")
        return version

    def replace(self, rows: DataFrame, order_by: list[Column | str] | None = None) -> int:
        """The table's new content as a whole; `rows` may read from it."""
        base = self.pointer()
        return self.publish(self.write(rows, order_by=order_by), base.version, list(base.folders))

    def expire(self, keep: int) -> int:
        """Drop all versions but the newest `keep`, and the folders that only dropped ones name; the number of folders dropped."""
        versions = self.versions()
        old, kept = versions[: max(0, len(versions) - keep)], versions[max(0, len(versions) - keep) :]
        named = lambda numbers: {f"batch={b}/{p}".rstrip("/") for v in numbers for p, b in self.pointer(v).folders.items()}
        unused = named(old) - named(kept)
        for version in old:
            delete_path(self.spark, self._path(version))
        for folder in unused:
            delete_path(self.spark, f"{self.root}/data/{folder}")
        return len(unused)

