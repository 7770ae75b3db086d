"""Stored tables that are replaced in one step.

Every write goes to a folder of its own, `layer/table/v-<id>`, which nobody reads yet. What readers see is named by the
layer's manifest: of the numbered files in `layer/_manifest` the one with the highest number counts. A commit writes the
next one and renames it into its place, which fails if another writer has taken the number; then the changes are made
again to what that writer left. So a reader finds the old tables or the new ones, whole, whenever a writer stops. Folders
that a commit has replaced are removed after it, so a query over an older version that still runs then ends in an error
and is to be asked again; those of writers that stopped are removed by `remove_orphans`.

The rename must be atomic, as it is on HDFS and POSIX file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyward.sources.shared import exists, folders_in, read_text, remove, write_new

MANIFEST = "_manifest"
ATTEMPTS = 100


class Conflict(RuntimeError):
    """Another writer has committed the same table since it was read."""


@dataclass(frozen=True)
class Stored:
    """One stored table: its folders below the layer, whose rows together are the table.

    `prints` are folders with the fingerprints of its rows, one for each folder, if they are kept; `buckets` and
    `bucket_by` say how the first folder is dealt by key, if it is; `facts` holds folders of what was derived from it.
    """

    folders: tuple[str, ...]
    schema: str
    n_rows: int
    partition_by: tuple[str, ...] = ()
    prints: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    facts: dict[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    @property
    def all_folders(self) -> set[str]:
        return {*self.folders, *self.prints, *self.facts.values()}

    def to_json(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_json(read: Mapping) -> Stored:
        tuples = ("folders", "partition_by", "prints", "bucket_by")
        return Stored(**{k: tuple(v) if k in tuples else v for k, v in read.items()})


def new_folder(name: str, kind: str = "v") -> str:
    """A fresh folder of a table, below its layer."""
    return f"{name.lower()}/{kind}-{uuid.uuid4().hex}"


def _latest(spark: SparkSession, root: str, layer: str) -> int:
    return max((int(f[:-5]) for f in folders_in(spark, f"{root}/{layer}/{MANIFEST}") if f.endswith(".json") and f[:-5].isdigit()), default=0)


def _read(spark: SparkSession, root: str, layer: str, number: int) -> dict[str, Stored]:
    if not number:
        return {}
    read = json.loads(read_text(spark, f"{root}/{layer}/{MANIFEST}/{number:010d}.json"))
    return {name: Stored.from_json(entry) for name, entry in read.items()}


def current(spark: SparkSession, root: str, layer: str) -> dict[str, Stored]:
    """The tables of a layer, by name in lower case."""
    return _now(spark, root, layer)[1]


def _now(spark: SparkSession, root: str, layer: str) -> tuple[int, dict[str, Stored]]:
    """Number and tables of the last commit. A manifest that a newer one has replaced while it was looked up is gone."""
    while True:
        number = _latest(spark, root, layer)
        try:
            return number, _read(spark, root, layer, number)
        except Py4JJavaError:
            if _latest(spark, root, layer) == number:
                raise


def commit(
    spark: SparkSession,
    root: str,
    layer: str,
    changes: Mapping[str, Stored | None],
    whole: bool = False,
    expected: Mapping[str, Stored | None] | None = None,
    kept: Collection[str] = (),
) -> None:
    """Make the changes visible in one step; None takes a table out. With `whole`, no other table stays.

    `expected` are tables that must still be as they were read, else nothing is changed and `Conflict` is raised. Folders
    in `kept` are not removed though they are replaced.
    """
    changes = {name.lower(): entry for name, entry in changes.items()}
    for _ in range(ATTEMPTS):
        number, before = _now(spark, root, layer)
        for name, entry in (expected or {}).items():
            if before.get(name.lower()) != entry:
                raise Conflict(f"{layer}/{name} was changed by another writer")
        after = {} if whole else dict(before)
        after.update({name: entry for name, entry in changes.items() if entry is not None})
        for name, entry in changes.items():
            if entry is None:
                after.pop(name, None)
        text = json.dumps({name: entry.to_json() for name, entry in sorted(after.items())}, indent=1)
        if write_new(spark, f"{root}/{layer}/{MANIFEST}/{number + 1:010d}.json", text):
            break
    else:
        raise Conflict(f"{layer} is changed by other writers all the time")
    used = {folder for entry in after.values() for folder in entry.all_folders} | set(kept)
    for folder in sorted({folder for entry in before.values() for folder in entry.all_folders} - used):
        _remove_unused(spark, f"{root}/{layer}", folder, used)
    if number:
        remove(spark, f"{root}/{layer}/{MANIFEST}/{number:010d}.json")


def _remove_unused(spark: SparkSession, path: str, folder: str, used: Collection[str]) -> None:
    """Remove a folder, but not those of its partitions that are used by themselves."""
    if not any(u.startswith(f"{folder}/") for u in used):
        remove(spark, f"{path}/{folder}")
        return
    for child in folders_in(spark, f"{path}/{folder}"):
        if "=" in child and f"{folder}/{child}" not in used:
            remove(spark, f"{path}/{folder}/{child}")


def remove_orphans(spark: SparkSession, root: str, layer: str, kept: Collection[str] = ()) -> list[str]:
    """Remove what no manifest names: folders of writers that stopped, and of tables taken out. Not while others write.

    Returns what was removed, below the layer.
    """
    used = {folder for entry in current(spark, root, layer).values() for folder in entry.all_folders} | set(kept)
    gone = []
    for name in folders_in(spark, f"{root}/{layer}"):
        if name == MANIFEST:
            continue
        inside = folders_in(spark, f"{root}/{layer}/{name}")
        lost = [f"{name}/{child}" for child in inside if not any(u == f"{name}/{child}" or u.startswith(f"{name}/{child}/") for u in used)]
        gone += [name] if len(lost) == len(inside) else lost
    for path in gone:
        remove(spark, f"{root}/{layer}/{path}")
    return gone


def is_whole(spark: SparkSession, root: str, layer: str, entry: Stored) -> bool:
    """Whether every folder of an entry was written to its end."""
    return all(exists(spark, f"{root}/{layer}/{written_folder(folder)}/_SUCCESS") for folder in entry.all_folders)


def written_folder(folder: str) -> str:
    """The folder of one write: an entry may be some of the partitions below it."""
    return "/".join(folder.split("/")[:2])


def rows_of(spark: SparkSession, root: str, layer: str, entry: Stored, schema: StructType | str | None = None) -> DataFrame:
    """The rows of an entry, folder by folder; a table without folders is empty."""
    struct = entry.struct if schema is None else schema
    found = None
    for folder in entry.folders:
        reader = spark.read.schema(struct)
        if entry.partition_by:  # a folder of one partition tells the value of its column
            reader = reader.option("basePath", f"{root}/{layer}/{written_folder(folder)}")
        part = reader.parquet(f"{root}/{layer}/{folder}")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], struct) if found is None else found
