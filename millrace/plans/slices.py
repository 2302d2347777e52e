"""The log of slices: which files an id has below a path, and which run of which job wrote them.

A job is a name, a run of it is one application (or one ``Sender``).  Within a run every export is the next
slice and goes on with the numbers; the first slice of another run of the same job takes the place of what
the run before has left, whole or half done.  Files of other jobs, and files that no log knows, stay.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

from millrace.plans.direct import list_name, listed_names
from millrace.session import Files


@dataclass(frozen=True)
class Slice:
    """An entry of the log; ``files`` are relative to the path, ``done`` once all have their names."""

    job: str
    run: str
    batch: int | None = None
    done: bool = False
    files: tuple[str, ...] = ()
    #: direct exports: what is added to the numbers of attempts, the first number that only this slice can
    #: have, the last that it has, and those of its tasks when it is done; each of them keeps a list of its files
    offset: int | None = None
    low: int | None = None
    last: int = -1
    numbers: tuple[int, ...] = ()
    #: the export failed; tasks that were still at work may have left files since
    failed: bool = False
    key: str = field(default="", compare=False)


class SliceLog:
    """A hidden folder below the path with a small file for each slice."""

    def __init__(self, files: Files, path: str, id: str):
        self._files = files
        self.folder = posixpath.join(path, f".{id}.slices")

    def entries(self) -> list[Slice]:
        if not self._files.exists(self.folder):
            return []
        found = []
        for name, _ in sorted(self._files.names(self.folder)):
            if name.endswith(".slice"):
                entry = json.loads(self._files.read_text(posixpath.join(self.folder, name)))
                found.append(Slice(**{**entry, "files": tuple(entry["files"]), "numbers": tuple(entry.get("numbers", ())), "key": name}))
        return found

    def manifest(self, entry: Slice) -> str:
        return posixpath.join(self.folder, entry.key.removesuffix(".slice") + ".files")

    def lists(self, entry: Slice) -> list[str]:
        """Where the tasks of a direct export list their files."""
        return [list_name(self.manifest(entry), number) for number in entry.numbers]

    def names(self, entry: Slice) -> Iterator[str]:
        """All files of an entry, one by one."""
        yield from entry.files
        for place in self.lists(entry):
            yield from listed_names(self._files.read_text(place))

    def note(self, entry: Slice) -> Slice:
        """Write the entry, over what it was before."""
        entry = entry if entry.key else replace(entry, key=f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.slice")
        body = {k: v for k, v in asdict(entry).items() if k != "key"}
        target = posixpath.join(self.folder, entry.key)
        staged = posixpath.join(self.folder, f".{entry.key}")
        self._files.write_text(staged, json.dumps(body))
        self._files.replace(staged, target)
        return entry

    def forget(self, entries: list[Slice]) -> None:
        stems = {entry.key.removesuffix(".slice") for entry in entries}
        if not stems or not self._files.exists(self.folder):
            return
        for name, _ in self._files.names(self.folder):
            if name.endswith(".files") and name.partition(".")[0] in stems:
                self._files.remove(posixpath.join(self.folder, name))
        for entry in entries:
            self._files.remove(posixpath.join(self.folder, entry.key))


def superseded(entries: list[Slice], job: str, run: str, batch: int | None) -> list[Slice]:
    """What the next slice of the run replaces: other runs of its job, or earlier tries of a stream's batch."""
    mine = [e for e in entries if e.job == job]
    if batch is not None:
        return [e for e in mine if e.batch == batch]
    return [e for e in mine if e.batch is None and e.run != run]
