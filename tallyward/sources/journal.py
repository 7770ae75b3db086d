"""What a run has written, so that the next one after a failure goes on from there.

Every finished write leaves one small file in `root/_journal`, named by a digest of what went into it: layer, table, the
fingerprints of its inputs, parameters and the library's code. A later run that comes to the same step finds the file and
takes the rows as they are. Nothing of it is visible to readers before the run commits its layers.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from functools import cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.prints import row_prints
from tallyward.sources.manifest import Stored, is_whole
from tallyward.sources.shared import folders_in, read_text, remove, write_new

JOURNAL = "_journal"


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()


@cache
def code_print() -> str:
    """Digest of the code that decides what is stored, so that another version starts anew."""

    def sources(folder) -> Iterator[bytes]:
        for child in sorted(folder.iterdir(), key=lambda c: c.name):
            if child.is_dir():
                yield from sources(child)
            elif child.name.endswith(".py"):
                yield child.read_bytes()

    read = hashlib.sha256()
    for name in ("functions", "operators", "plans", "sources"):
        for source in sources(files("tallyward") / name):
            read.update(source)
    return read.hexdigest()


def input_print(df: DataFrame) -> str:
    """What a table holds: of a plain table of files their names, sizes and times, else count and summed hashes of its rows."""
    return file_print(df) or _row_print(df, df.agg(*_row_sums(df)).first().asDict())


def file_print(df: DataFrame) -> str | None:
    """Of a plain table of files what `input_print` says, without reading it; else none."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and (paths := df.inputFiles()):
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        found = []
        for path in sorted(paths):
            where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
            status = where.getFileSystem(conf).getFileStatus(where)
            found.append((path, status.getLen(), status.getModificationTime()))
        return digest("files", df.schema.json(), found)
    return None


def observed_print(df: DataFrame) -> tuple[DataFrame, Callable[[], str]]:
    """The rows, and what `input_print` says of them once they have been written: no pass of its own."""
    seen = Observation()
    return df.observe(seen, *_row_sums(df)), lambda: _row_print(df, seen.get)


def _row_sums(df: DataFrame) -> list[Column]:
    sums = [F.sum(p.cast("decimal(38,0)")).alias(n) for p, n in zip(row_prints(df), "ab", strict=True)]
    return [F.count(F.lit(1)).alias("n"), *sums]


def _row_print(df: DataFrame, found: Mapping) -> str:
    return digest("rows", df.schema.json(), *[v if v is None else int(v) for v in (found[n] for n in "nab")])


class Journal:
    """The finished steps below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.seen: set[str] = set()
        self.kept: set[tuple[str, str]] = set()

    def _path(self, key: str) -> str:
        return f"{self.root}/{JOURNAL}/{key}.json"

    def step(self, layer: str, name: str, inputs: tuple, write: Callable[[], Stored]) -> tuple[Stored, str]:
        """The entry of a table and the key of its step: as an earlier run left it, or written now."""
        key = self._key(layer, name, inputs)
        if f"{key}.json" in folders_in(self.spark, f"{self.root}/{JOURNAL}"):
            entry = Stored.from_json(json.loads(read_text(self.spark, self._path(key)))["entry"])
            if is_whole(self.spark, self.root, layer, entry):
                self.kept.add((name, layer))
                return entry, key
            remove(self.spark, self._path(key))
        return self._finished(layer, key, write())

    def first_step(self, layer: str, name: str, df: DataFrame, write: Callable[[DataFrame], Stored]) -> tuple[Stored, str]:
        """As `step` for a table of which no step is in the journal, so that its input need not be known before it is written."""
        observed, found = observed_print(df)
        entry = write(observed)
        return self._finished(layer, self._key(layer, name, (found(),)), entry)

    def _key(self, layer: str, name: str, inputs: tuple) -> str:
        key = digest(layer, name.lower(), code_print(), *inputs)
        self.seen.add(key)
        return key

    def _finished(self, layer: str, key: str, entry: Stored) -> tuple[Stored, str]:
        write_new(self.spark, self._path(key), json.dumps({"layer": layer, "entry": entry.to_json()}))
        return entry, key

    def tables(self) -> set[tuple[str, str]]:
        """(layer, table in lower case) of all finished steps."""
        return {(layer, folder.split("/")[0]) for layer, entry in self.entries() for folder in entry.all_folders}

    def entries(self) -> list[tuple[str, Stored]]:
        """(layer, entry) of all finished steps."""
        names = [f for f in folders_in(self.spark, f"{self.root}/{JOURNAL}") if f.endswith(".json") and not f.startswith(".")]
        read = [json.loads(read_text(self.spark, f"{self.root}/{JOURNAL}/{f}")) for f in names]
        return [(r["layer"], Stored.from_json(r["entry"])) for r in read]

    def forget_others(self) -> None:
        """Remove the steps that this run has not come to."""
        for name in folders_in(self.spark, f"{self.root}/{JOURNAL}"):
            if name.removesuffix(".json") not in self.seen:
                remove(self.spark, f"{self.root}/{JOURNAL}/{name}")
