"""Binary files in the shared scratch folder, opened by tasks.

``file:`` and plain paths are opened directly, others through Arrow's file systems.
"""

from __future__ import annotations


def _local(path: str) -> str | None:
    scheme, sep, rest = path.partition(":")
    if not sep or "/" in scheme:
        return path
    return "/" + rest.lstrip("/") if scheme == "file" else None


def _remote(path: str):
    from urllib.parse import quote

    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


class written:  # noqa: N801  used as a context manager
    """A file that appears under its name only when it is complete, so that a task that runs twice replaces it whole."""

    def __init__(self, path: str):
        self.path = path

    def __enter__(self):
        import os
        import uuid

        self.local = _local(self.path)
        if self.local is None:
            self.system, inner = _remote(self.path)
            self.name, self.temporary = inner, f"{inner}.{uuid.uuid4().hex}"
            self.handle = self.system.open_output_stream(self.temporary)
        else:
            os.makedirs(os.path.dirname(self.local), exist_ok=True)
            self.temporary = f"{self.local}.{uuid.uuid4().hex}"
            self.handle = open(self.temporary, "wb")
        return self.handle

    def __exit__(self, kind, error, trace):
        import os

        self.handle.close()
        if kind is not None:
            return
        if self.local is None:
            self.system.move(self.temporary, self.name)
        else:
            os.replace(self.temporary, self.local)


def opened(path: str):
    """A file for reading at any place."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    import io

    system, inner = _remote(path)
    return io.BufferedReader(system.open_input_file(inner), 8 << 20)


def mapped(path: str, kind: str):
    """The file as a flat array; local and mounted files are memory-mapped, others read."""
    import os

    import numpy as np

    local = _local(path)
    if local is None:
        with opened(path) as handle:
            return np.frombuffer(handle.read(), kind)
    return np.memmap(local, kind, "r") if os.path.getsize(local) else np.zeros(0, kind)


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files of a folder that end with ``suffix``, by name."""
    import os

    local = _local(path)
    if local is not None:
        names = sorted(os.listdir(local)) if os.path.isdir(local) else []
        return [(f"{local.rstrip('/')}/{n}", os.path.getsize(f"{local}/{n}")) for n in names if n.endswith(suffix)]
    from pyarrow import fs

    system, inner = _remote(path)
    scheme = path.partition(":")[0]
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted((f"{scheme}://{f.path}", f.size) for f in found if f.path.endswith(suffix))
