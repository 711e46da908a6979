"""The files each slice was loaded from, and the loads that were cut off.

A load leaves two records in the ledger of its slice: an intent before it writes, and its end after the commit.
The files it writes are named by the load. An intent without an end belongs to a run that died: its files are
known by their name, so the next load takes them out again before it reads the staged files anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from decimal import Decimal
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratalake.config import Lake, LakeTable
from stratalake.errors import BadInput
from stratalake.sources.stage import list_files
from stratalake.workspace import (
    delete_file,
    delete_path,
    folder_entries,
    path_exists,
    read_text,
    write_text,
)

INTENT, DONE = ".intent.json", ".done.json"


@dataclass(frozen=True)
class StagedFile:
    """A staged file as a listing found it; ``path`` opens it."""

    path: str
    length: int
    modified: int

    @property
    def key(self) -> str:
        return same_form(self.path)

    @property
    def state(self) -> tuple[int, int]:
        return self.length, self.modified


def same_form(name: str) -> str:
    """A file name without differences of spelling (``file:/x``, ``file:///x``), to compare names by."""
    parts = urlparse(name)
    return f"{parts.netloc}{unquote(parts.path)}"


def staged_files(spark: SparkSession, folder: str) -> list[StagedFile]:
    """The files of a stage folder, in one listing; as many names as Spark plans a scan with."""
    if not path_exists(spark, folder):
        return []
    files = list_files(spark, folder, recursive=True)
    rows = files.select("path", "length", F.unix_millis("modificationTime").alias("modified"))
    return sorted((StagedFile(*row) for row in rows.collect()), key=lambda f: f.key)


@dataclass(frozen=True)
class Fingerprint:
    """A multiset of rows in three numbers that do not depend on their order.

    Fingerprints of parts add up to that of the whole.
    """

    rows: int = 0
    total: int = 0
    xor: int = 0

    @staticmethod
    def of(found: Mapping[str, object]) -> Fingerprint:
        """From the aggregates of a write or a scan."""
        total = found["fingerprint_sum"]
        return Fingerprint(found["rows"], int(Decimal(total or 0)), found["fingerprint_xor"] or 0)

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.rows + other.rows, self.total + other.total, self.xor ^ other.xor)


@dataclass(frozen=True)
class Load:
    """One load of a slice: the files it reads, and what it wrote once it has ended."""

    number: int
    name: str
    replaces: bool
    files: list[StagedFile]
    wrote: Fingerprint = field(default_factory=Fingerprint)

    @property
    def prefix(self) -> str:
        """How the names of its files begin."""
        return f"carga-{self.name}"

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Load:
        found = json.loads(text)
        files = [StagedFile(**f) for f in found.pop("files")]
        return Load(files=files, wrote=Fingerprint(**found.pop("wrote")), **found)


@dataclass(frozen=True)
class Plan:
    """What the next load of a slice has to do.

    ``read`` are the files to read: all staged ones for a load that replaces the slice, only those it does not hold
    yet for one that adds to it. ``held`` is what the slice holds beside them; ``gone`` files were
    loaded and are not staged any more.
    """

    replaces: bool
    read: list[StagedFile]
    held: Fingerprint
    gone: int = 0
    undone: int = 0

    @property
    def late(self) -> bool:
        return self.gone > 0


class Ledger:
    """The loads of one slice."""

    def __init__(self, spark: SparkSession, lake: Lake, table: LakeTable, load_date: str):
        self.spark = spark
        self.slice = f"{table.name} of {load_date}"
        self.folder = f"{lake.root}/_loaded/{lake.database(table.database)}/{table.name}/{load_date}"
        self.ended, self.cut_off = self._records()

    def _records(self) -> tuple[list[Load], list[Load]]:
        """Loads that ended, from the last that replaced the slice on, and those that were cut off."""
        if not path_exists(self.spark, self.folder):
            return [], []
        names = [name for name, _ in folder_entries(self.spark, self.folder)]
        done = [Load.parse(read_text(self.spark, n)) for n in names if n.endswith(DONE)]
        known = {load.name for load in done}
        begun = [Load.parse(read_text(self.spark, n)) for n in names if n.endswith(INTENT)]
        done.sort(key=lambda load: load.number)
        first = max((i for i, load in enumerate(done) if load.replaces), default=0)
        return done[first:], [load for load in begun if load.name not in known]

    def plan(self, staged: list[StagedFile], undo_paths: Iterable[str], appends: bool = False) -> Plan:
        """Undo what a dead run left, and decide which staged files the next load reads and how.

        The slice is replaced as long as every file it was loaded from is still staged; else only new files are
        read. Raises where neither gives a whole slice: loaded files have changed while others are gone, or
        the files of a load that was cut off are gone. ``undo_paths`` are the folders a load writes to.
        """
        now = {f.key: f for f in staged}
        for load in self.cut_off:
            missing = [f for f in load.files if f.key not in now]
            if missing:
                raise BadInput(
                    f"a load of {self.slice} was cut off and {len(missing)} of the files it read are gone: "
                    "it can be neither finished nor undone"
                )
        undone = 0
        for load in self.cut_off:
            if not load.replaces:
                undone += undo(self.spark, load, undo_paths)
            delete_file(self.spark, self._name(load, INTENT))
        if appends:
            return Plan(False, staged, Fingerprint(), undone=undone)
        before = {f.key: f for load in self.ended for f in load.files}
        gone = [key for key in before if key not in now]
        changed = [key for key, f in before.items() if key in now and now[key].state != f.state]
        if gone and changed:
            raise BadInput(
                f"{len(changed)} loaded files of {self.slice} have changed while others are gone: "
                "it can be neither replaced nor extended"
            )
        if not gone:
            return Plan(True, staged, Fingerprint(), undone=undone)
        held = sum((load.wrote for load in self.ended), Fingerprint())
        return Plan(False, [f for f in staged if f.key not in before], held, len(gone), undone)

    def begin(self, plan: Plan) -> Load:
        """Write down a load before it writes anything else."""
        number = max((load.number for load in (*self.ended, *self.cut_off)), default=0) + 1
        load = Load(number, uuid.uuid4().hex, plan.replaces, plan.read)
        write_text(self.spark, self._name(load, INTENT), load.text())
        return load

    def end(self, load: Load, wrote: Fingerprint) -> None:
        """Write down that a load is committed, then forget the loads it replaced."""
        ended = Load(load.number, load.name, load.replaces, load.files, wrote)
        write_text(self.spark, self._name(load, DONE), ended.text())
        delete_file(self.spark, self._name(load, INTENT))
        if load.replaces:
            for old in self.ended:
                delete_file(self.spark, self._name(old, DONE))
            self.ended = []
        self.ended.append(ended)

    def abandon(self, load: Load) -> None:
        """Forget a load that failed before it committed anything."""
        delete_file(self.spark, self._name(load, INTENT))

    def _name(self, load: Load, kind: str) -> str:
        return f"{self.folder}/{load.number:08d}-{load.name}{kind}"


def undo(spark: SparkSession, load: Load, folders: Iterable[str]) -> int:
    """Delete the files a load wrote, and the temporary folder its writer left; returns how many there were."""
    count = 0
    for folder in folders:
        if not path_exists(spark, folder):
            continue
        for name, is_folder in folder_entries(spark, folder):
            last = name.rsplit("/", 1)[-1]
            if not is_folder and last.lstrip(".").startswith(load.prefix):
                count += delete_file(spark, name) and not last.startswith(".")
            elif is_folder and last == "_temporary":
                delete_path(spark, name)
    return count
