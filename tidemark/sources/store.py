"""Files through Hadoop's file systems, so that every path may lie on a shared or remote store.

Only names and small files pass through the driver's memory; larger ones are copied by the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch

from pyspark.sql import SparkSession

#: Ending of the small file that keeps the hash of the file beside it.
HASH = ".sha256"


class Store:
    """Keyed files below a root on any file system that Hadoop knows (``file:``, ``hdfs:``, ``s3a:`` ...)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.files = self.root.getFileSystem(self.conf)

    def path(self, key: str):  # noqa: ANN201 - a path of the JVM
        return self.jvm.org.apache.hadoop.fs.Path(self.root, key) if key else self.root

    def exists(self, key: str) -> bool:
        """Whether there is a file or folder of this name; failures other than absence are errors."""
        return self.files.exists(self.path(key))

    def read(self, key: str) -> bytes:
        """The whole of a small file."""
        stream = self.files.open(self.path(key))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, key: str, data: bytes) -> None:
        """A small file, written beside its place and put there by renaming."""
        fresh = self.path(f"{key}.new")
        stream = self.files.create(fresh, True)
        stream.write(bytearray(data))
        stream.close()
        self.replace(f"{key}.new", key)

    def replace(self, fresh: str, key: str) -> None:
        """Put a file or folder in the place of another; the old one is gone only when the new one stands."""
        old = f"{key}.old"
        self.delete(old)
        if self.exists(key):
            self.files.rename(self.path(key), self.path(old))
        if not self.files.rename(self.path(fresh), self.path(key)):
            raise OSError(f"cannot rename to {key}")
        self.delete(old)

    def delete(self, key: str) -> None:
        self.files.delete(self.path(key), True)

    def listed(self, prefix: str = "", pattern: str = "*") -> list[tuple[str, int]]:
        """Keys and sizes of all files below a prefix whose last part fits the pattern, in order; listed
        page by page by the file system."""
        if not self.exists(prefix):
            return []
        base = self.files.makeQualified(self.root).toString().rstrip("/") + "/"
        pages, found = self.files.listFiles(self.path(prefix), True), []
        while pages.hasNext():
            one = pages.next()
            key = one.getPath().toString().removeprefix(base)
            name = key.rsplit("/", 1)[-1]
            if fnmatch(name, pattern) and not name.startswith((".", "_")) and not key.endswith(HASH):
                found.append((key, one.getLen()))
        return sorted(found)

    def copied(self, key: str, other: Store, into: str | None = None) -> None:
        """Copy one file to another store, by the JVM, beside its place and then renamed."""
        into = into or key
        if not self.jvm.org.apache.hadoop.fs.FileUtil.copy(self.files, self.path(key), other.files, other.path(f"{into}.new"), False, True, self.conf):
            raise OSError(f"cannot copy {key}")
        other.replace(f"{into}.new", into)

    def digest(self, key: str) -> str:
        """SHA-256 of a file, read by the JVM in pieces."""
        stream = self.files.open(self.path(key))
        try:
            return str(self.jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream))
        finally:
            stream.close()

    def known_digest(self, key: str) -> str | None:
        """The hash kept beside a file, None where there is none."""
        return self.read(key + HASH).decode().strip() if self.exists(key) and self.exists(key + HASH) else None


def pull(store: Store, keys: Iterable[str], into: Store, dry_run: bool = False) -> dict[str, str]:
    """Copy files of a store: what was done by key (``pulled``, ``missing``). A missing key is skipped, any
    other failure is an error."""
    done = {}
    for key in keys:
        if not store.exists(key):
            done[key] = "missing"
            continue
        if not dry_run:
            store.copied(key, into)
        done[key] = "pulled"
    return done


def push(local: Store, keys: Iterable[str], store: Store, dry_run: bool = False, names: dict[str, str] | None = None) -> dict[str, str]:
    """Copy files to a store: ``same`` where the hash kept there is that of the file, ``missing`` where there is
    no such file, else ``pushed``. The hash is written last, so a push that stopped is done again."""
    done = {}
    for key in keys:
        target = (names or {}).get(key, key)
        if not local.exists(key):
            done[key] = "missing"
            continue
        digest = local.digest(key)
        if store.known_digest(target) == digest:
            done[key] = "same"
            continue
        if not dry_run:
            store.delete(target + HASH)
            local.copied(key, store, target)
            store.write(target + HASH, digest.encode())
        done[key] = "pushed"
    return done


def push_release(local: Store, sets: dict[str, list[str]], stores: dict[str, Store], date: str, snapshots: Iterable[str] = (), dry_run: bool = False) -> dict[str, dict[str, str]]:
    """Push the list of files of each store (such as ``private`` and ``public``), and of each file of
    ``snapshots`` a copy ``snapshots/<name>-<date>`` to the stores that get it; nothing is ever deleted."""
    done = {}
    for name, keys in sets.items():
        done[name] = push(local, keys, stores[name], dry_run)
        for key in snapshots:
            if key in keys:
                stem, dot, end = key.rsplit("/", 1)[-1].partition(".")
                dated = f"snapshots/{stem}-{date.replace('-', '')}{dot}{end}"
                done[name][dated] = push(local, [key], stores[name], dry_run, {key: dated})[key]
    return done


def archived(source: Store, target: Store, prefix: str, pattern: str = "*", dry_run: bool = False, threads: int = 8) -> list[str]:
    """Copy the files below a prefix that the target lacks or has in another size; works either way."""
    have = dict(target.listed(prefix, pattern))
    wanted = [key for key, size in source.listed(prefix, pattern) if have.get(key) != size]
    if not dry_run:
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(lambda key: source.copied(key, target), wanted))
    return wanted


