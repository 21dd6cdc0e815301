"""Files written and read inside tasks, on any file system that Arrow knows."""

from __future__ import annotations

from pyarrow import fs


def _place(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def writer(uri: str):
    """An output stream; its folder is made where the store has folders."""
    store, path = _place(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def reader(uri: str):
    """A file that can be read at any offset."""
    store, path = _place(uri)
    return store.open_input_file(path)


def read_all(uri: str) -> bytes:
    with reader(uri) as f:
        return f.read()
