"""A data source that writes lines of text as bzip2 files, in a folder that driver and
executors share under one path.

Hadoop's codec, written in Java, sorts blocks of 900 kB and has no other size. Here the C
library behind Python's ``bz2`` does that work, in blocks of 100 kB: both are faster, and
so is reading. The files are plain bzip2, read by any reader and split at their blocks.
"""

from __future__ import annotations

import bz2
import os
import shutil
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "bzip2_lines"
# In units of 100 kB.
BLOCK = 1
# Readers skip names that start with an underscore.
STAGING = "_temporary"


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class _Writer(DataSourceArrowWriter):
    """Tasks write below ``STAGING``; the driver moves what the successful ones wrote.
    What lay in the folder before goes last, so a failed job leaves it as it was."""

    def __init__(self, path: str, suffix: str):
        self.path, self.suffix, self.job = path, suffix, uuid.uuid4().hex
        self.staged = os.path.join(path, STAGING, self.job)

    def write(self, iterator):
        name, out = None, None
        packer = bz2.BZ2Compressor(BLOCK)
        try:
            for batch in iterator:
                lines = batch.column(0).to_pylist()
                if not lines:
                    continue
                if out is None:
                    # Each attempt of a task has a file of its own.
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{self.suffix}"
                    os.makedirs(self.staged, exist_ok=True)
                    out = open(os.path.join(self.staged, name), "wb")
                out.write(packer.compress("\n".join([*lines, ""]).encode()))
            if out is not None:
                out.write(packer.flush())
        finally:
            if out is not None:
                out.close()
        return _Written(name)

    def commit(self, messages):
        os.makedirs(self.staged, exist_ok=True)
        for name in os.listdir(self.path):
            if name != STAGING:
                _remove(os.path.join(self.path, name))
        for message in messages:
            if message is not None and message.name:
                os.rename(os.path.join(self.staged, message.name), os.path.join(self.path, message.name))
        _remove(os.path.join(self.path, STAGING))
        open(os.path.join(self.path, "_SUCCESS"), "wb").close()

    def abort(self, messages):
        shutil.rmtree(self.staged, ignore_errors=True)


def _remove(path: str) -> None:
    if os.path.isdir(path) and not os.path.islink(path):
        shutil.rmtree(path)
    else:
        os.remove(path)


class Bzip2Lines(DataSource):
    """Option ``path``: a folder of the local file system, replaced as a whole.
    Option ``suffix``: what file names end in."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "value string"

    def writer(self, schema, overwrite):
        path = self.options["path"]
        if not overwrite:
            raise ValueError(f"{FORMAT} replaces its folder: use mode('overwrite')")
        if os.path.isfile(path):
            os.remove(path)
        return _Writer(path, self.options.get("suffix", ".bz2"))
