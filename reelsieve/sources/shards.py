"""Tar shards and text sinks that stream: one member at a time, on any store that pyarrow opens."""

from __future__ import annotations

import io
import tarfile
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MEMBERS

SCHEMA = "shard string, name string, size long, data binary, error string"
_BATCH = 16 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def members(spark: SparkSession, path: str, wanted: tuple[str, ...] | None = None, content: bool = True) -> DataFrame:
    """One row per file in the tars below path: shard, name, size, data; a damaged tar keeps what is before the damage and ends with an error row.

    Spark lists the tars and deals them to tasks; a task streams one member after another, so neither an archive nor a batch of
    large members is ever whole in memory, and without content only headers are read. wanted: suffixes to keep.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar").load(path).select("path")
    names = ["shard", "name", "size", "data", "error"]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    def read(shard: str):
        store, at = _open(shard)
        try:
            with store.open_input_file(at) as file, tarfile.open(fileobj=file, mode="r:") as tar:
                while (info := tar.next()) is not None:
                    tar.members = []  # the listing isn't kept
                    if info.isfile() and (not wanted or info.name.endswith(wanted)):
                        data = tar.extractfile(info).read() if content else None
                        if data is not None and len(data) < info.size:
                            raise tarfile.ReadError("unexpected end of data")
                        yield shard, info.name, info.size, data, None
        except (tarfile.TarError, EOFError, OSError) as e:
            yield shard, None, None, None, f"{type(e).__name__}: {e}"

    def each(batches):
        rows, held = [], 0
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                for row in read(shard):
                    rows.append(row)
                    held += len(row[3] or b"")
                    if held > _BATCH or len(rows) == 1024:
                        yield packed(rows)
                        rows, held = [], 0
        if rows:
            yield packed(rows)

    return files.mapInArrow(each, SCHEMA)


def rejected(rows: DataFrame, required: tuple[str, ...] = MEMBERS) -> DataFrame:
    """sample, missing: samples that lack a required member. rows: sample, ext."""
    want = F.array(*map(F.lit, required))
    return rows.groupBy("sample").agg(F.array_sort(F.array_except(want, F.collect_set("ext"))).alias("missing")).where(F.size("missing") > 0)


def write(rows: DataFrame, path: str, prefix: str = "shard") -> DataFrame:
    """Write tar shards; shard, path, n_samples, n_members, bytes of each. rows: shard (number), sample, ext, data.

    A shard's members come to one task in the order of sample and extension and are streamed into the archive, one at a time.
    A shard is written under a passing name and renamed at its end, so a lost task leaves no half shard and its repetition
    replaces the same file. The returned table has to be used (written or collected once) for the shards to be made.
    """
    path = path if "://" in path else f"file://{path}"
    names = ["shard", "path", "n_samples", "n_members", "bytes"]
    dealt = rows.select("shard", "sample", "ext", "data").repartition("shard").sortWithinPartitions("shard", "sample", "ext")

    def each(batches):
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        now = tar = sink = passing = last = None
        samples = count = size = 0

        def ended():
            tar.close()
            sink.close()
            final = f"{root}/{prefix}-{now:06d}.tar"
            store.move(passing, final)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([final]), *(pa.array([x], pa.int64()) for x in (samples, count, size))], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                shard, sample, ext, data = (batch.column(k)[i].as_py() for k in range(4))
                if shard != now:
                    if tar is not None:
                        yield ended()
                    now, last, samples, count, size = shard, None, 0, 0, 0
                    passing = f"{root}/_passing-{uuid.uuid4().hex}"
                    sink = store.open_output_stream(passing)
                    tar = tarfile.open(fileobj=sink, mode="w|")
                info = tarfile.TarInfo(f"{sample}.{ext}")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                samples, count, size, last = samples + (sample != last), count + 1, size + len(data), sample
        if tar is not None:
            yield ended()

    return dealt.mapInArrow(each, "shard long, path string, n_samples long, n_members long, bytes long")
