"""Tables of very many small folders on a local disk, written by tasks through Arrow.

Without Hadoop's native library its local file system starts a process (``chmod``)
for each folder and file it makes, and a table of a folder per instrument and
month is hardly more than folders and files: a small file took some 90 ms of a
core, of which the rows were one. Here tasks make them by plain system calls,
under the names and with the footers that Spark's own writer gives them. Each
attempt of a task has a folder of its own, and the driver moves those of the
attempts that succeeded, so a repeated or speculative task leaves nothing behind.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote, urlsplit

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.names import NO_VALUE

#: What Spark escapes in the names of partition folders.
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}
ATTEMPTS = "_attempts"
#: Rows of a folder that a task holds before they are written as a row group.
HELD_BYTES = 64 << 20
FEW_ROWS = 1_000
CODECS = {"uncompressed": "none"}


def folder_name(columns: Sequence[str], values: Iterable[str | None]) -> str:
    return "/".join(f"{c.translate(ESCAPED)}={v.translate(ESCAPED) if v else NO_VALUE}" for c, v in zip(columns, values))


def _runs(batch, columns: Sequence[str]) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of rows with the same values in some columns, as (values, first row, number of rows)."""
    import numpy as np
    import pyarrow.compute as pc

    encoded = [pc.run_end_encode(batch.column(c)) for c in columns]
    ends = [e.run_ends.to_numpy() for e in encoded]
    stops = np.unique(np.concatenate(ends))
    values = [np.array(e.values.to_pylist(), dtype=object)[np.searchsorted(at, stops)] for e, at in zip(encoded, ends)]
    start = 0
    for stop, *key in zip(stops.tolist(), *values):
        yield tuple(key), start, stop - start
        start = stop


class _Files:
    """The files of one attempt of a task; one is open at a time."""

    def __init__(self, top: str, name: str, schema, compression: str) -> None:
        self.top, self.name, self.schema = top, name, schema
        codec = CODECS.get(compression, compression)
        self.options = {"compression": codec, "store_schema": False} | ({"compression_level": 6} if codec == "gzip" else {})
        self.held, self.bytes, self.rows, self.made = [], 0, 0, 0
        self.folder = self.writer = None

    def add(self, folder: str, rows) -> None:
        if folder != self.folder:
            self.close()
            self.folder = folder
        self.held.append(rows)
        self.bytes += rows.nbytes
        self.rows += rows.num_rows
        if self.bytes >= HELD_BYTES:
            self.flush()

    def flush(self) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if not self.held:
            return
        if self.writer is None:
            os.makedirs(f"{self.top}/{self.folder}", exist_ok=True)
            path = f"{self.top}/{self.folder}/{self.name}.c{self.made:03d}.{self.options['compression']}.parquet"
            # a dictionary of few rows is one page more to write and to read
            self.writer = pq.ParquetWriter(path, self.schema, use_dictionary=self.rows > FEW_ROWS, **self.options)
            self.made += 1
        self.writer.write_table(pa.Table.from_batches(self.held))
        self.held, self.bytes, self.rows = [], 0, 0

    def close(self) -> None:
        self.flush()
        if self.writer is not None:
            self.writer.close()
        self.folder = self.writer = None


def write_folders(df: DataFrame, place: str, partition_by: Sequence[str], compression: str = "gzip") -> None:
    """Write rows, sorted by the partition columns inside each task, below a local folder that does not exist yet.

    A task holds a batch and up to ``HELD_BYTES`` of one folder.
    """
    columns = [c for c in df.columns if c not in partition_by]
    written = df.select(*columns).schema.json()
    run, parts = uuid.uuid4().hex, [f"_part_{c}" for c in partition_by]
    # other types have their text in the name, as Spark casts it
    rows = df.select(*columns, *[F.col(c).cast("string").alias(p) for c, p in zip(partition_by, parts)])

    def write(batches):
        import pyarrow as pa

        task = TaskContext.get()
        top = f"{place}/{ATTEMPTS}/{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
        files = None
        for batch in batches:
            data = batch.select(columns)
            if files is None:
                schema = data.schema.with_metadata({"org.apache.spark.sql.parquet.row.metadata": written})
                files = _Files(top, f"part-{task.partitionId():05d}-{run}", schema, compression)
            for key, start, n in _runs(batch, parts):
                files.add(folder_name(partition_by, key), data.slice(start, n))
        if files is not None:
            files.close()
            yield pa.RecordBatch.from_pydict({"top": [top]})

    os.makedirs(place)
    for row in rows.mapInArrow(write, "top string").collect():
        if os.path.isdir(row["top"]):
            _merge(row["top"], place)
    shutil.rmtree(f"{place}/{ATTEMPTS}", ignore_errors=True)
    open(f"{place}/_SUCCESS", "w").close()


def _merge(source: str, target: str) -> None:
    """Move everything under a folder to another; a folder that is not there yet moves as a whole."""
    with os.scandir(source) as found:
        for entry in list(found):
            to = f"{target}/{entry.name}"
            if not os.path.exists(to):
                os.rename(entry.path, to)
            else:
                _merge(entry.path, to)


def delete_folders(folders: DataFrame, column: str) -> None:
    """Delete local folders, named as URIs, in tasks. One that is gone is no error."""

    def delete(rows) -> None:
        for row in rows:
            path = unquote(urlsplit(row[column]).path)
            if os.path.isdir(path):
                shutil.rmtree(path)

    # as many tasks as there are shuffle partitions: the names are few bytes, which adaptive execution puts in one
    at_once = int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folders.select(column).repartition(at_once).foreachPartition(delete)
