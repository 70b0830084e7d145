"""A folder that partition actions write files to, each row once whatever runs again.

Tasks write files that no reader looks at, under names that are used only once. A commit moves
those that count to the folder of their batch. A batch that is committed again
takes the place of what it left before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


class Staged:
    """A task's files; ``receipt`` names those that it has finished."""

    def __init__(self, system: fs.FileSystem, folder: str, suffix: str):
        self.system, self.folder, self.suffix = system, folder, suffix
        self.names: list[str] = []

    def new(self) -> str:
        """A path for one more file, in a file system that ``system`` is."""
        name = f"{uuid.uuid4().hex}{self.suffix}"
        self.names.append(name)
        return f"{self.folder}/{name}"

    def receipt(self) -> list[str]:
        return list(self.names)


class Outbox:
    """A resource that opens as ``Staged``. ``uri`` is a folder with its scheme, on a store that executors and driver share."""

    def __init__(self, uri: str, suffix: str = ".parquet"):
        self.uri, self.suffix = uri.rstrip("/"), suffix

    def _at(self, folder: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(f"{self.uri}/{folder}")

    @contextmanager
    def __call__(self) -> Iterator[Staged]:
        system, path = self._at("staged")
        system.create_dir(path, recursive=True)
        yield Staged(system, path, self.suffix)

    @property
    def sent(self) -> str:
        """The folder that readers read; it is there once something was committed."""
        return f"{self.uri}/sent"

    def commit(self, receipts: list[list[str]], batch_id: int | None) -> None:
        """Publish a batch of a stream in place of an earlier run of it, or one more batch by itself."""
        name = f"batch_id={batch_id}" if batch_id is not None else f"batch_id={uuid.uuid4().hex}"
        system, path = self._at(f"sent/{name}")
        _, staged = self._at("staged")
        names = [n for receipt in receipts for n in receipt]
        kept = {f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True))}
        system.create_dir(path, recursive=True)
        for gone in kept - set(names):
            system.delete_file(f"{path}/{gone}")
        for moved in set(names) - kept:
            system.move(f"{staged}/{moved}", f"{path}/{moved}")

    def abort(self, receipts: list[list[str]], batch_id: int | None) -> None:
        system, path = self._at("staged")
        for receipt in receipts:
            for name in receipt:
                system.delete_file(f"{path}/{name}")
