"""Parquet tables whose versions follow one another as a whole.

Every write goes to a folder of its own, ``commit=<id>``, with the partition folders below
it. What counts is named by a pointer, a small JSON file put in place by one rename: the
commits of the version, and the partition folders in them that later commits have replaced.
A reader that has opened the newest pointer sees all of a commit or nothing, whatever has
happened to a write. Folders that no version since the last one names are removed by the next
commit, so a reader has the time of one commit to finish. A table has one writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTERS = "_versions"
COMMIT = "commit"
#: So many of the newest pointers are kept.
KEPT_POINTERS = 8
#: So many commits of a level are merged into one of the next.
MOST_COMMITS = 24
_MERGED = "merged-"
# Fixed value: Spark's folder name for a NULL partition value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    number: int
    columns: list[str]
    #: Ids of the commits that count, with the label each was given or "".
    commits: dict[str, str] = field(default_factory=dict)
    #: Partition folders in them that do not, as ``commit=.../column=value/...``.
    retired: list[str] = field(default_factory=list)
    #: Of commits made to replace partitions, the folders that count; so that the next one
    #: need not look for them.
    folders: dict[str, list[str]] = field(default_factory=dict)


class _Files:
    """The few file operations a commit needs, in whatever store the table lies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._system = self.of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def of(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing where there is none."""
        if not self._system.exists(self.of(path)):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self.of(path))]

    def read(self, path: str) -> str:
        stream = self._system.open(self.of(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Write a file whole, by renaming; an error if it is there."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self._system.create(self.of(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._system.exists(self.of(path)) or not self._system.rename(self.of(draft), self.of(path)):
            self._system.delete(self.of(draft), False)
            raise RuntimeError(f"another commit has made {path}")

    def remove(self, path: str) -> None:
        self._system.delete(self.of(path), True)


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version, or ``None`` for a folder that has none."""
    files = _Files(spark, path)
    pointers = [n for n in files.names(f"{path}/{POINTERS}") if re.fullmatch(r"\d{9}\.json", n)]
    if not pointers:
        return None
    newest = max(pointers)
    found = json.loads(files.read(f"{path}/{POINTERS}/{newest}"))
    return Version(int(newest[:9]), **found)


def _partition_folders(spark: SparkSession, folder: str) -> set[str]:
    """The partition folders of one commit; its files are listed, none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.option("pathGlobFilter", "*.parquet").load(folder).inputFiles()
    return {unquote(file).split(folder.rsplit("/", 1)[1] + "/", 1)[1].rsplit("/", 1)[0] for file in files}


def _values(folder: str) -> list[str | None]:
    """Partition values out of a folder's name."""
    found = [part.split("=", 1)[1] for part in folder.split("/")]
    return [None if v == _NULL_FOLDER else unquote(v) for v in found]


def _key(columns: Sequence[str]) -> Column:
    """One text for the values of partition columns, as ``_key_of`` makes it."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
    return F.concat_ws("\x1f", *texts)


def _key_of(values: Sequence[str | None]) -> str:
    return "\x1f".join("" if v is None else f"={v}" for v in values)


def commit(
    df: DataFrame, path: str, columns: Sequence[str], label: str | None = None, hint: Sequence[str] = (),
    order: Sequence[Column] = (), merges: Sequence[str] = (),
) -> str:
    """Write ``df`` in folders of ``columns`` and make it count; returns the commit's id.

    Without a label the partitions that occur in ``df`` replace the old ones of the same
    values, and all others stay. With a label the rows are added, in the place of an
    earlier commit with the label, or of the commits that ``merges`` names. ``df`` may read
    the table itself. ``hint`` names the columns to bring together first, ``order`` sorts
    rows in a file.
    """
    spark, files, columns = df.sparkSession, _Files(df.sparkSession, path), list(columns)
    old = current(spark, path)
    if old is None:
        if any(not n.startswith(("_", ".", f"{COMMIT}=")) for n in files.names(path)):
            raise ValueError(f"{path} holds data without versions")
        old = Version(0, columns)
    elif old.columns != columns:
        raise ValueError(f"{path} is partitioned by {old.columns}, not by {columns}")
    number = old.number + 1
    name = f"{number:09d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{COMMIT}={name}"
    rows = df.hint("rebalance", *hint) if hint else df
    if order:
        rows = rows.sortWithinPartitions(*columns, *order)
    writer = rows.write
    (writer.partitionBy(*columns) if columns else writer).parquet(folder)

    commits, folders, retired = dict(old.commits), dict(old.folders), []
    if merges:
        commits = {c: found for c, found in commits.items() if c not in merges}
    elif label is not None:
        commits = {c: found for c, found in commits.items() if found != label}
    elif not columns:
        commits = {}
    else:
        if set(commits) - set(folders):
            raise ValueError(f"rows of {path} are added by labels, not replaced")
        fresh = _partition_folders(spark, folder)
        for c, mine in old.folders.items():
            folders[c] = sorted(set(mine) - fresh)
            if folders[c]:
                retired += [f"{COMMIT}={c}/{place}" for place in sorted(fresh.intersection(mine))]
        commits = {c: found for c, found in commits.items() if c not in folders or folders[c]}
        folders[name] = sorted(fresh)
    commits[name] = label or ""
    _sweep(files, path, old)
    pointer = {
        "columns": columns, "commits": commits, "folders": {c: f for c, f in folders.items() if c in commits},
        "retired": [r for r in retired if r not in set(old.retired)],
    }
    files.put(f"{path}/{POINTERS}/{number:09d}.json", json.dumps(pointer, indent=1))
    pointers = sorted(n for n in files.names(f"{path}/{POINTERS}") if n.endswith(".json"))
    for outdated in pointers[:-KEPT_POINTERS]:
        files.remove(f"{path}/{POINTERS}/{outdated}")
    return name


def _sweep(files: _Files, path: str, old: Version) -> None:
    """Remove what ``old`` does not name: no reader of it, or of a later version, asks for that."""
    for place in old.retired:
        files.remove(f"{path}/{place}")
    for name in files.names(path):
        c = name.split("=", 1)[-1]
        if name.startswith(f"{COMMIT}=") and c not in old.commits and int(c[:9]) <= old.number:
            files.remove(f"{path}/{name}")


def live(rows: DataFrame, version: Version) -> DataFrame:
    """The rows that count; only partition columns are asked, so other folders are not read."""
    if not version.commits:
        return rows.where(F.lit(False))
    rows = rows.where(F.col(COMMIT).isin(list(version.commits)))
    if version.retired:
        dead = [_key_of(_values(place)) for place in version.retired]
        rows = rows.where(~_key([COMMIT, *version.columns]).isin(dead))
    return rows


def read_version(
    spark: SparkSession, path: str, version: Version, types: Mapping[str, str], schema: StructType | None = None
) -> DataFrame:
    """The rows of ``version`` with the commit they lie in.

    Partition columns have the given types, or are text.
    """
    if schema is None:
        newest = max(version.commits)
        schema = spark.read.option("basePath", path).parquet(f"{path}/{COMMIT}={newest}").schema
    fields = StructType([f for f in schema.fields if f.name not in version.columns and f.name != COMMIT])
    for name in version.columns:
        fields = fields.add(name, types.get(name, "string"))
    return live(spark.read.schema(fields.add(COMMIT, "string")).parquet(path), version)


def merge_commits(
    spark: SparkSession, path: str, schema: StructType, types: Mapping[str, str], most: int = MOST_COMMITS
) -> int:
    """Merge commits of equal level where there are ``most`` of them; returns how many went.

    A load's commit has level 0, one that commits of a level were merged into the next. So
    a row is rewritten once a level, the commits of a table that is only added to stay few
    however many loads there were, and so do its folders and files. No row changes. Labels
    of merged commits are forgotten: a load that died is to be repeated before.
    """
    gone = 0
    while (version := current(spark, path)) is not None:
        levels: dict[int, list[str]] = {}
        for c, label in version.commits.items():
            merged = re.fullmatch(rf"{_MERGED}(\d+)", label)
            levels.setdefault(int(merged[1]) if merged else 0, []).append(c)
        full = [level for level, found in levels.items() if len(found) >= most]
        if not full:
            return gone
        level = min(full)
        rows = read_version(spark, path, version, types, schema).where(F.col(COMMIT).isin(levels[level]))
        commit(rows.drop(COMMIT), path, version.columns, f"{_MERGED}{level + 1}", hint=version.columns, merges=levels[level])
        gone += len(levels[level])
    return gone
