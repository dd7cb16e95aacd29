"""Files in the shared folder, opened from tasks."""

from pyarrow import fs


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, for a local path, ``file:`` or any other URI."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def create(path: str):
    """A new file for writing, bytes as they are; its folder is made if there is none."""
    system, name = open_system(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name, compression=None)


def open_file(path: str):
    """A file for reading at any place."""
    system, name = open_system(path)
    return system.open_input_file(name)
