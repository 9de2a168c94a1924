"""Small file-system helpers (pyarrow.fs) for driver-side renames and task-side streams.

Works for local paths and any URI pyarrow understands (s3://, gs://, hdfs://).
Only metadata operations run on the driver; file bodies are read and written
inside Spark tasks.
"""

from __future__ import annotations

from pyarrow import fs as pafs


#: Names that Spark's file systems use for stores which pyarrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs", "abfss": "abfs"}


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return pafs.LocalFileSystem(), path
    scheme, colon, rest = uri.partition(":")
    if colon and scheme == "dbfs":  # mounted on every node
        return pafs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if colon and scheme in SCHEMES:
        uri = f"{SCHEMES[scheme]}:{rest}"
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def exists(uri: str) -> bool:
    f, p = resolve(uri)
    return f.get_file_info(p).type != pafs.FileType.NotFound


def makedirs(uri: str) -> None:
    f, p = resolve(uri)
    f.create_dir(p, recursive=True)


def move(src: str, dst: str) -> None:
    f, s = resolve(src)
    _, d = resolve(dst)
    f.move(s, d)


def touch(uri: str) -> None:
    f, p = resolve(uri)
    with f.open_output_stream(p) as out:
        out.write(b"")


def list_folders(uri: str) -> list[str]:
    """The folders directly under a folder, as URIs or paths like the one given; none where it is absent."""
    f, p = resolve(uri)
    found = f.get_file_info(pafs.FileSelector(p, recursive=False, allow_not_found=True))
    return sorted(f"{uri.rstrip('/')}/{i.base_name}" for i in found if i.type == pafs.FileType.Directory)


def remove_folder(uri: str) -> None:
    """Delete a folder with what it holds, if it is there."""
    f, p = resolve(uri)
    if f.get_file_info(p).type == pafs.FileType.Directory:
        f.delete_dir(p)


def list_files(uri: str, recursive: bool = True) -> list[str]:
    f, p = resolve(uri)
    sel = pafs.FileSelector(p, recursive=recursive, allow_not_found=True)
    return sorted(i.path for i in f.get_file_info(sel) if i.type == pafs.FileType.File)


def empty_files(uri: str) -> list[str]:
    """Files without a byte under a folder, hidden ones (``_`` or ``.`` first) left out."""
    f, p = resolve(uri)
    found = f.get_file_info(pafs.FileSelector(p, recursive=True, allow_not_found=True))
    hidden = lambda path: any(x.startswith(("_", ".")) for x in path[len(p) :].split("/") if x)
    return sorted(i.path for i in found if i.type == pafs.FileType.File and i.size == 0 and not hidden(i.path))
