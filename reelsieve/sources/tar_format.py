"""Tar shards as a Spark data source: spark.read.format("tar") and df.write.format("tar").

register(spark) makes the format known to a session. One row is one member: shard, name, size, data, error.

Reading. Options: path; suffixes (comma-separated: members with other endings are skipped); content ("false": no data); done
(a folder of Parquet or JSON lines with the columns shard, name that lists members which are not wanted any more);
partBytes (an archive is read by one task for each so many bytes of it); pushFilters ("true": filters on shard and name, namely =,
IN, LIKE 'x%', '%x', '%x%', are taken over by the source: archives that they rule out are not opened, members that they rule
out not read. Spark 4.1 keeps one reader for each load(), so with this option a query has to load anew for each filter; without
it, which is the default, a loaded table can be used in any way). A task steps
over the headers before its part, a block each, so a member that holds an archive itself is never taken for one. A damaged
archive gives what is before the damage, and one row with an error, which has no name and passes no filter on it.

Writing. Rows are samples: sample, members (map of extension to bytes). Options: path; prefix ("shard"); capacity (samples in a
shard, 1000); invalid ("fail": an invalid sample ends the job with its reason; "reject": it is left out and listed with its
reason in <prefix>-rejected.jsonl); frames (a number: arrays have to be so long; "any"; or "unchecked": only the members' names are
looked at). Tasks write under a passing folder, which readers skip. Shards get their names, numbered on from those that are there
(append) or from 0 (overwrite), when all tasks are through; a failed or repeated task leaves no shard.
"""

from __future__ import annotations

import io
import json
import posixpath
import tarfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..config import MEMBERS, Constants
from .shards import SCHEMA

_NAMES = ["shard", "name", "size", "data", "error"]
_KINDS = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
_BATCH = 16 << 20
_PASSING = "_passing"
#: The tolerance of the first pose, the intrinsics of a frame.
FIRST_POSE, INTRINSICS = 1e-3, (1, 4)
CLIP_FRAMES = Constants.camera_frames


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarSource)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it; a path without a scheme is local."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{posixpath.abspath(path)}")


def _archives(store: fs.FileSystem, root: str) -> list[fs.FileInfo]:
    """Tars at or below root in order of their paths; folders and files that start with _ or . are passed over."""
    top = store.get_file_info(root)
    if top.type == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    found = [top] if top.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(root) :].split("/"))
    return sorted((x for x in found if x.type == fs.FileType.File and x.path.endswith(".tar") and not hidden(x.path)), key=lambda x: x.path)


_TESTS: dict[type, Callable[[Filter], Callable[[str], bool]]] = {
    EqualTo: lambda f: lambda x: x == f.value,
    In: lambda f: lambda x: x in set(f.value),
    StringStartsWith: lambda f: lambda x: x.startswith(f.value),
    StringEndsWith: lambda f: lambda x: x.endswith(f.value),
    StringContains: lambda f: lambda x: f.value in x,
}


@dataclass
class Part(InputPartition):
    """Members of one archive whose headers begin in [low, high)."""

    shard: str
    low: int
    high: int


@dataclass
class TarReader(DataSourceReader):
    path: str
    suffixes: tuple[str, ...] = ()
    content: bool = True
    done: str | None = None
    part_bytes: int = 1 << 30
    push: bool = False
    filters: list[Filter] = field(default_factory=list)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if self.push and type(f) in _TESTS and f.attribute in (("shard",), ("name",)):
                self.filters.append(f)
            else:
                yield f

    def _passes(self, column: str, value: str) -> bool:
        return all(_TESTS[type(f)](f)(value) for f in self.filters if f.attribute == (column,))

    def partitions(self) -> list[Part]:
        store, root = opened(self.path)
        parts = []
        for x in _archives(store, root):
            if self._passes("shard", x.path):
                edges = range(0, max(x.size, 1), self.part_bytes)
                parts += [Part(x.path, low, low + self.part_bytes) for low in edges]
        return parts or [Part("", 0, 0)]

    def _ledger(self, shard: str) -> set[str]:
        """Names of the shard's members that are listed as done; only its own rows are read."""
        if not self.done:
            return set()
        store, at = opened(self.done)
        kind = "json" if any(x.path.endswith(".json") for x in store.get_file_info(fs.FileSelector(at))) else "parquet"
        listed = ds.dataset(at, filesystem=store, format=kind, exclude_invalid_files=False)
        return set(listed.to_table(columns=["name"], filter=ds.field("shard") == shard)["name"].to_pylist())

    def _members(self, part: Part) -> Iterator[tuple]:
        store, _ = opened(self.path)
        at = 0
        try:
            done = self._ledger(part.shard)
            with store.open_input_file(part.shard) as file, tarfile.open(fileobj=file, mode="r:") as tar:
                while (info := tar.next()) is not None:
                    tar.members = []  # the listing isn't kept
                    if info.offset >= part.high:
                        return
                    at = info.offset
                    if at < part.low or not info.isfile() or self.suffixes and not info.name.endswith(self.suffixes) or not self._passes("name", info.name) or info.name in done:
                        continue
                    data = tar.extractfile(info).read() if self.content else None
                    if data is not None and len(data) < info.size:
                        raise tarfile.ReadError("unexpected end of data")
                    yield part.shard, info.name, info.size, data, None
                # An unreadable header ends the walk like the zeros of a whole archive.
                file.seek(tar.offset)
                if file.read(tarfile.BLOCKSIZE).strip(b"\0"):
                    raise tarfile.ReadError("damaged header")
        except (tarfile.TarError, EOFError, OSError) as e:
            # The part that has the last good header reports it; those after it can't get past the damage either.
            if part.low <= at < part.high and not any(f.attribute == ("name",) for f in self.filters):
                yield part.shard, None, None, None, f"{type(e).__name__}: {e}"

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in self._members(part) if part.shard else ():
            rows.append(row)
            held += len(row[3] or b"")
            if held > _BATCH or len(rows) == 1024:
                yield _packed(rows)
                rows, held = [], 0
        if rows:
            yield _packed(rows)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_KINDS)], names=_NAMES)


def problem(sample: str | None, members: dict[str, bytes], required: tuple[str, ...] = MEMBERS, frames: int | str = CLIP_FRAMES) -> str | None:
    """Why a sample can't be packed, or null: its name, its members, the shapes and types of its arrays, its caption, its first pose."""
    if not sample:
        return "sample has no name"
    if missing := [x for x in required if members.get(x) is None]:
        return f"missing members: {', '.join(missing)}"
    if frames == "unchecked":
        return None
    n = None if frames == "any" else int(frames)
    arrays = {}
    for name, tail in (("poses_c2w", (4, 4)), ("intrinsics", INTRINSICS), ("scale", ())):
        try:
            arrays[name] = x = np.load(io.BytesIO(members[f"{name}.npy"]), allow_pickle=False)
        except (ValueError, OSError, EOFError) as e:
            return f"{name}: unreadable array ({e})"
        wanted = ("T" if n is None else n, *tail)
        if x.ndim != len(wanted) or x.shape[1:] != tail or n is not None and len(x) != n:
            return f"{name}: shape {x.shape}, not ({', '.join(map(str, wanted))})"
        if x.dtype != np.float32:
            return f"{name}: type {x.dtype}, not float32"
        if not len(x):
            return f"{name}: no frames"
    if len({len(x) for x in arrays.values()}) > 1:
        return "arrays differ in length: " + ", ".join(f"{k} {len(x)}" for k, x in arrays.items())
    if not members["caption.txt"].decode("utf-8", "replace").strip():
        return "caption is empty"
    if not np.allclose(arrays["poses_c2w"][0], np.eye(4), atol=FIRST_POSE):
        return "first pose is not the identity"
    return None


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: passing paths with their samples, and the rejected samples with their reasons."""

    shards: list[tuple[str, int]]
    rejected: list[tuple[str, str]]


@dataclass
class TarWriter(DataSourceWriter):
    path: str
    prefix: str
    capacity: int
    reject: bool
    frames: int | str
    overwrite: bool
    job: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def passing(self) -> tuple[fs.FileSystem, str]:
        store, root = opened(self.path)
        return store, f"{root}/{_PASSING}-{self.job}"

    def write(self, rows: Iterator) -> Written:
        store, folder = self.passing
        shards: list[tuple[str, int]] = []
        rejected: list[tuple[str, str]] = []
        tar = sink = None
        count = 0

        def close() -> None:
            nonlocal tar
            tar.close()
            sink.close()
            shards.append((at, count))
            tar = None

        required = MEMBERS if self.frames != "unchecked" else ()
        try:
            for row in rows:
                if why := problem(row.sample, row.members or {}, required, self.frames):
                    if not self.reject:
                        raise ValueError(f"sample {row.sample}: {why}")
                    rejected.append((row.sample, why))
                    continue
                if tar is None:
                    at, count = f"{folder}/{uuid.uuid4().hex}", 0
                    sink = store.open_output_stream(at)
                    tar = tarfile.open(fileobj=sink, mode="w|")
                # Known members in their own order, others after them.
                for ext in sorted(row.members, key=lambda x: (MEMBERS.index(x) if x in MEMBERS else len(MEMBERS), x)):
                    info = tarfile.TarInfo(f"{row.sample}.{ext}")
                    info.size = len(row.members[ext])
                    tar.addfile(info, io.BytesIO(row.members[ext]))
                count += 1
                if count == self.capacity:
                    close()
            if tar is not None:
                close()
        except BaseException:
            if tar is not None:
                sink.close()
                shards.append((at, count))
            for at, _ in shards:
                if store.get_file_info(at).type == fs.FileType.File:
                    store.delete_file(at)
            raise
        return Written(shards, rejected)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        done = [m for m in messages if m is not None]
        there = [x.path for x in _archives(store, root) if posixpath.dirname(x.path) == root and posixpath.basename(x.path).startswith(f"{self.prefix}-")] if store.get_file_info(root).type != fs.FileType.NotFound else []
        first = 0
        if not self.overwrite:
            numbers = [posixpath.basename(x)[len(self.prefix) + 1 : -len(".tar")] for x in there]
            first = max((int(x) + 1 for x in numbers if x.isdigit()), default=0)
        else:
            for x in there:
                store.delete_file(x)
        for k, (at, _) in enumerate((x for m in done for x in m.shards), first):
            store.move(at, f"{root}/{self.prefix}-{k:06d}.tar")
        if lines := [json.dumps({"sample": s, "reason": w}, ensure_ascii=False) for m in done for s, w in m.rejected]:
            log = f"{root}/{self.prefix}-rejected.jsonl"
            before = b""
            if not self.overwrite and store.get_file_info(log).type == fs.FileType.File:
                with store.open_input_file(log) as file:
                    before = file.read()
            with store.open_output_stream(log) as out:
                out.write(before + ("\n".join(lines) + "\n").encode())
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, at = self.passing
        if store.get_file_info(at).type == fs.FileType.Directory:
            store.delete_dir(at)


class TarSource(DataSource):
    """The format "tar"; see the module."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TarReader:
        o = self.options
        suffixes = tuple(x.strip() for x in o.get("suffixes", "").split(",") if x.strip())
        return TarReader(o["path"], suffixes, o.get("content", "true").lower() != "false", o.get("done"), int(o.get("partBytes", 1 << 30)), o.get("pushFilters", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> TarWriter:
        o = self.options
        capacity = int(o.get("capacity", 1000))
        if capacity < 1:
            raise ValueError(f"a shard holds at least one sample, not {capacity}")
        if not {"sample", "members"} <= set(schema.names):
            raise ValueError("rows need the columns sample and members (map of extension to bytes)")
        if (invalid := o.get("invalid", "fail")) not in ("fail", "reject"):
            raise ValueError(f"invalid is fail or reject, not {invalid}")
        out = TarWriter(o["path"], o.get("prefix", "shard"), capacity, invalid == "reject", o.get("frames", CLIP_FRAMES), overwrite)
        # Made once, here: a task that is still running when the job is given up finds no folder any more.
        store, at = out.passing
        store.create_dir(at, recursive=True)
        return out
