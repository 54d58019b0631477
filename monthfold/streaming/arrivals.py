"""A stream of folder listings: a new batch whenever a file arrives, changes or goes."""

from __future__ import annotations

import hashlib
import re
import sys
from datetime import datetime, timezone

import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from monthfold.sources.discovery import LISTING, file_system

# The reader goes along with its tasks: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Files that one task of a batch carries.
FILES_PER_TASK = 10_000


def glob_pattern(glob: str) -> re.Pattern:
    """A file name pattern with ``*``, ``?``, ``[...]`` and ``{a,b}`` as a regular expression."""
    out, depth, i = "", 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif c == "[" and "]" in glob[i + 2 :]:
            end = glob.index("]", i + 2)
            out += "[" + glob[i + 1 : end].replace("!", "^", 1) + "]"
            i = end
        elif c == "{" or (c == "}" and depth):
            depth += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return re.compile(out, re.DOTALL)


def listed(folder: str, glob: str) -> list[tuple]:
    """(path, source_file, length, modification_time) of the files that a Spark listing would give."""
    system, root, prefix = file_system(folder)
    root = root.rstrip("/")
    match = glob_pattern(glob)
    rows = []
    for info in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        below = info.path[len(root) :].lstrip("/").split("/")
        if info.type != pafs.FileType.File or not info.size or not match.fullmatch(below[0]):
            continue
        if any(part.startswith(("_", ".")) for part in below):
            continue
        changed = datetime.fromtimestamp(info.mtime_ns // 1_000_000 / 1000, timezone.utc)
        rows.append((f"{prefix}{info.path}", below[0], info.size, changed))
    return sorted(rows)


class Chunk(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class ListingReader(DataSourceStreamReader):
    """Offsets are digests over name, size and time of all files; a batch is the listing behind its end."""

    def __init__(self, options):
        self.folder, self.glob = options["path"], options["pattern"]
        self.seen: dict[str, list[tuple]] = {}

    def initialOffset(self) -> dict:
        return {"digest": ""}

    def latestOffset(self) -> dict:
        rows = listed(self.folder, self.glob)
        digest = hashlib.sha256(repr(rows).encode()).hexdigest() if rows else ""
        self.seen = {digest: rows}
        return {"digest": digest}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        # After a restart the listing behind a planned batch is gone: what is there now takes its place.
        rows = self.seen.get(end["digest"])
        if rows is None:
            rows = listed(self.folder, self.glob)
        return [Chunk(rows[i : i + FILES_PER_TASK]) for i in range(0, len(rows), FILES_PER_TASK)] or [Chunk([])]

    def read(self, partition: Chunk):
        yield from partition.rows


class Arrivals(DataSource):
    """``spark.readStream.format("monthfold_arrivals").option("pattern", glob).load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "monthfold_arrivals"

    def schema(self) -> str:
        return LISTING

    def streamReader(self, schema) -> ListingReader:
        return ListingReader(self.options)
