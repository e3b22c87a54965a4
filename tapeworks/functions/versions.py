"""Read models that are kept by the version of what they are made from.

A model is a folder of versions and one pointer file. A version is named by a fingerprint of the input files; a new
one is written beside the old ones, and then the pointer moves, so a reader sees a whole version and one that has
begun with the old one ends with it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(spark: SparkSession, paths: Sequence[str], also: str = "") -> str:
    """A hash of the names, sizes and times of all files at ``paths``, and of ``also``, such as the version of the code.

    Files are listed by Spark, so any store that it reads will do; their contents aren't read. The driver gets three numbers.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", "length", "modificationTime")
    one = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.bit_xor(one).alias("a"), F.sum(one.cast("decimal(38,0)")).alias("b")).first()
    return hashlib.sha256(f"{row['n']} {row['bytes']} {row['a']} {row['b']} {also}".encode()).hexdigest()[:32]


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


def current(root: str) -> dict | None:
    """What the pointer of the model at ``root`` says (path, version), or None without one."""
    store, path = _store(root)
    if store.get_file_info(f"{path}/CURRENT").type != pafs.FileType.File:
        return None
    with store.open_input_stream(f"{path}/CURRENT") as source:
        return json.loads(source.read())


def publish(root: str, path: str, version: str) -> None:
    """Moves the pointer of the model at ``root``: written under a name of its own first, so that no reader sees half of it."""
    store, at = _store(root)
    store.create_dir(at, recursive=True)
    own = f"{at}/.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as sink:
        sink.write(json.dumps({"path": path, "version": version}).encode())
    store.move(own, f"{at}/CURRENT")


def read_model(spark: SparkSession, root: str, inputs: Sequence[str], build: Callable[[], DataFrame], also: str = "", again: bool = False) -> DataFrame:
    """The model of ``inputs`` as they are now: read where the pointer names their version, else built, written and published.

    Has the column refreshed_at. Two writers at once each publish a whole version of their own. ``also`` tells builds by
    other code apart; with ``again`` it is built in any case.
    """
    version = fingerprint(spark, inputs, also)
    known = None if again else current(root)
    if known is None or known["version"] != version or not is_there(known["path"]):
        path = f"{root}/{version}-{uuid.uuid4().hex}"
        build().withColumn("refreshed_at", F.current_timestamp()).write.parquet(path)
        publish(root, path, version)
        known = {"path": path}
    return spark.read.parquet(known["path"])


def is_there(path: str) -> bool:
    store, at = _store(path)
    return store.get_file_info(at).type != pafs.FileType.NotFound


def prune(root: str, keep: int = 2) -> int:
    """Deletes all but the ``keep`` newest versions and the one the pointer names; returns how many went."""
    store, at = _store(root)
    named = current(root)
    folders = sorted((i for i in store.get_file_info(pafs.FileSelector(at)) if i.type == pafs.FileType.Directory), key=lambda i: i.mtime or 0)
    gone = [i for i in folders[: len(folders) - keep] if named is None or not named["path"].endswith(i.base_name)]
    for i in gone:
        store.delete_dir(i.path)
    return len(gone)
