"""Small file-system helper over the Hadoop FileSystem that Spark itself uses.

Going through Hadoop's FileSystem (rather than ``os``) keeps the same code valid for HDFS and local disks, whose
rename refuses an existing target.  Object stores without such a rename need one writer for each table.  Only metadata-sized work happens here: listing a folder, writing or reading a manifest of a few
kilobytes, an atomic create-if-absent used as the commit point of a table version.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


_HANDLES: dict = {}


class FS:
    """Hadoop FileSystem access with the JVM class handles and file systems cached per session."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        key = id(spark.sparkContext)
        if key not in _HANDLES:
            jvm = spark.sparkContext._jvm
            _HANDLES[key] = {"jvm": jvm, "Path": jvm.org.apache.hadoop.fs.Path,
                             "conf": spark.sparkContext._jsc.hadoopConfiguration(), "fs": {}}
        h = _HANDLES[key]
        self._jvm = h["jvm"]
        self._Path = h["Path"]
        self._conf = h["conf"]
        self._fss = h["fs"]

    def _path(self, p: str):
        return self._Path(p)

    def _fs(self, p: str):
        scheme = p.split(":", 1)[0] if ":" in p.split("/", 1)[0] else ""
        fs = self._fss.get(scheme)
        if fs is None:
            fs = self._fss[scheme] = self._path(p).getFileSystem(self._conf)
        return fs

    def exists(self, p: str) -> bool:
        return bool(self._fs(p).exists(self._path(p)))

    def mkdirs(self, p: str) -> None:
        self._fs(p).mkdirs(self._path(p))

    def ls(self, p: str) -> list[str]:
        """Names (not paths) of the entries of folder ``p``; empty when it does not exist."""
        if not self.exists(p):
            return []
        return [st.getPath().getName() for st in self._fs(p).listStatus(self._path(p))]

    def write_text(self, p: str, text: str, overwrite: bool = False) -> bool:
        """Create file ``p``.  Without ``overwrite`` the create is exclusive and returns False if it exists."""
        fs = self._fs(p)
        path = self._path(p)
        if not overwrite and fs.exists(path):
            return False
        tmp = self._path(f"{p}.{self._jvm.java.util.UUID.randomUUID().toString()}.tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if overwrite and fs.exists(path):
            fs.delete(path, False)
        # rename refuses an existing target, which makes it the commit point among concurrent writers
        ok = bool(fs.rename(tmp, path))
        if not ok:
            fs.delete(tmp, False)
        return ok

    def read_text(self, p: str) -> str:
        fs = self._fs(p)
        stream = fs.open(self._path(p))
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def delete(self, p: str, recursive: bool = True) -> None:
        fs = self._fs(p)
        if fs.exists(self._path(p)):
            fs.delete(self._path(p), recursive)

    def du(self, p: str) -> int:
        if not self.exists(p):
            return 0
        return int(self._fs(p).getContentSummary(self._path(p)).getLength())
