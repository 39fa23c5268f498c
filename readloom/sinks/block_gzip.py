"""Lines as block gzip files, one per task, that later readers can split.

``df.write.format("block_gzip").mode(...).save(path)`` takes a frame with one text
column; a value is written as it is, with a line end. Files are written under
hidden names and renamed when all tasks are done, so a lost task leaves nothing behind and a task run
twice counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from readloom.functions.shipping import ship
from readloom.functions.stores import store_of
from readloom.sources.blocks import LAST, MOST, member_of

ship(__name__)

PART = 1 << 10


@dataclass
class Written(WriterCommitMessage):
    hidden: str
    shown: str


class BlockGzip(DataSource):
    """Options: ``path``, ``ending`` of file names (``.txt.gz``), ``level``."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if len(schema.fields) != 1:
            raise ValueError("block gzip files hold one text column")
        return BlockWriter(self.options, overwrite)


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.root, self.overwrite = options["path"], overwrite
        self.ending, self.level = options.get("ending", ".txt.gz"), int(options.get("level", 6))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, base = store_of(self.root)
        store.create_dir(base)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{self.ending}"
        done = Written(f"{base}/_{name}.tmp", f"{base}/{name}")
        held = bytearray()
        with store.open_output_stream(done.hidden) as out:
            for batch in batches:
                values = batch.column(0).to_pylist()
                for low in range(0, len(values), PART):
                    held += "".join(f"{v or ''}\n" for v in values[low:low + PART]).encode()
                    whole = len(held) - len(held) % MOST
                    for at in range(0, whole, MOST):
                        out.write(member_of(bytes(held[at:at + MOST]), self.level))
                    del held[:whole]
            if held:
                out.write(member_of(bytes(held), self.level))
            out.write(LAST)
        return done

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, base = store_of(self.root)
        mine = {m.hidden for m in messages if m}
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if f.type == fs.FileType.File and f.path not in mine:
                    store.delete_file(f.path)
        for m in messages:
            if m:
                store.move(m.hidden, m.shown)

    def abort(self, messages) -> None:
        store, _ = store_of(self.root)
        for m in messages:
            if m:
                store.delete_file(m.hidden)


def write_block_gzip(lines: DataFrame, path: str, ending: str = ".txt.gz", level: int = 6) -> None:
    """The one text column of ``lines`` as block gzip files under ``path``, which is replaced."""
    lines.sparkSession.dataSource.register(BlockGzip)
    lines.write.format("block_gzip").mode("overwrite").option("ending", ending).option("level", str(level)).save(path)
