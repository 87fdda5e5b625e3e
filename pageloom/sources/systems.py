"""File systems of paths, inside a task."""

from __future__ import annotations


class Systems:
    """One client per scheme and host, made when first needed.

    A path without a scheme is one of the machine's own file system, or, as
    ``default``, of the file system given (``scheme://host``).
    """

    def __init__(self, default: str = ""):
        self.default = default.rstrip("/")
        self.made: dict = {}

    def find(self, path: str):
        """The file system of a path, and the path in it."""
        from pyarrow import fs

        if "://" not in path and self.default:
            path = f"{self.default}/{path.lstrip('/')}"
        scheme, mark, rest = path.partition("://")
        if not mark or scheme == "file":
            return self.made.setdefault("", fs.LocalFileSystem()), rest if mark else path.removeprefix("file:")
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        host, _, inner = rest.partition("/")
        key = f"{scheme}://{host}"
        if key not in self.made:
            try:
                self.made[key] = fs.FileSystem.from_uri(f"{key}/")[0]
            except Exception as failure:
                raise ValueError(f"No file system for {key}: {failure}") from failure
        return self.made[key], f"{host}/{inner}" if scheme in ("s3", "gs") else f"/{inner}"


def default_system(spark) -> str:
    """``scheme://host`` of Spark's default file system, empty if that is the machine's own."""
    name = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return "" if name.startswith("file:") else name.rstrip("/")
