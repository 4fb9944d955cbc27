"""Small file operations on whatever file system a path names (HDFS, an object store, local), through Hadoop."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


class Store:
    """File operations relative to a session; paths are the same strings that Spark's readers take."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, source: str, target: str) -> None:
        """Move ``source`` to ``target``, which must not exist; its parent folder is made."""
        fs, p = self._at(source)
        _, q = self._at(target)
        fs.mkdirs(q.getParent())
        if fs.exists(q):
            raise FileExistsError(target)
        if not fs.rename(p, q):
            raise OSError(f"could not move {source} to {target}")

    def names(self, path: str) -> list[str]:
        """Names of the entries of a folder, sorted; none if it is missing."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def write_json(self, path: str, value) -> None:
        """Written beside its place and renamed, so that a reader never sees half of it."""
        fs, p = self._at(path)
        _, draft = self._at(path + ".draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        out.close()
        fs.delete(p, False)
        if not fs.rename(draft, p):
            raise OSError(f"could not write {path}")

    def read_json(self, path: str):
        """The value, or None if there is no such file."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def fingerprint(self, *paths: str) -> str | None:
        """Digest of the names, lengths and change times of all files below the paths; None if one is missing.

        Only file metadata is read, as the driver lists it for a scan as well.
        """
        digest = hashlib.sha256()
        for path in sorted(paths):
            fs, p = self._at(path)
            if not fs.exists(p):
                return None
            files, found = fs.listFiles(p, True), []
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
            digest.update("\n".join([path, *sorted(found), ""]).encode())
        return digest.hexdigest()

    def listed(self, files: list[str]) -> str:
        """The same digest for single files, as ``DataFrame.inputFiles`` names them; each folder is listed once."""
        uri = self._jvm.java.net.URI
        path = self._jvm.org.apache.hadoop.fs.Path
        wanted, found = set(files), []
        for parent in sorted({f.rpartition("/")[0] for f in files}):
            p = path(uri(parent + "/"))
            for f in p.getFileSystem(self._conf).listStatus(p):
                name = f.getPath().toUri().toString()
                if name in wanted:
                    found.append(f"{name}|{f.getLen()}|{f.getModificationTime()}")
        if len(found) != len(wanted):
            raise FileNotFoundError(f"{len(wanted) - len(found)} input files are not there any more")
        return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()

    def sizes(self, path: str) -> list[tuple[str, int]]:
        """Names and lengths of the files below a folder."""
        fs, p = self._at(path)
        files, found = fs.listFiles(p, True), []
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().getName(), f.getLen()))
        return found
