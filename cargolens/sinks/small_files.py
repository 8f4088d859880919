"""Many small JSON files in one write (SNK1, SNK2), as a Python data source, and
their scan (SRC1).

Spark's file writers open, check and rename every file through Hadoop, which
costs more than ten events do. Here a task stages its files below
``_landing-<job>``, where no reader looks, and the commit moves them in place;
what a failed job or task staged is never seen.

Rows are (partition columns..., text). A file holds the texts of ``size`` rows
of one folder, in the task's order: as lines, or as one JSON array. Large
batches are compressed.

A folder takes ``FOLDER_FILES`` files of a job directly. Beyond that they stay
in the sub-folders ``files-<task>-<n>`` of at most as many, in which tasks
staged them, and each is moved by one rename. Spark finds them below partition
folders; where there are none, its readers need ``recursiveFileLookup``.

Spark's readers hold every file's name and status on the driver. ``read_files``
counts files there by folder, and tasks list the folders they are dealt.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cargolens.session import parallelism

FORMAT = "json_batches"
#: Rows of a file from which on it is compressed.
COMPRESS_FROM = 1_000
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Characters that Spark escapes in the names of partition folders.
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
MOVERS = 16
#: Files of a job that a folder takes directly, and the most of a sub-folder.
FOLDER_FILES = 10_000
SUB_FOLDER = "files-"
#: Tasks of a scan for each task slot, and the most files and bytes of an Arrow batch there.
SCAN_TASKS, SCAN_FILES, SCAN_BYTES = 4, 1_000, 4_000_000
#: Stores that rename a folder in one step.
RENAMING = ("local", "hdfs")


def open_store(path: str):
    """(file system, path) of pyarrow for a path as Spark writes it."""
    from pyarrow import fs

    if path.startswith("/"):
        return fs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path).rstrip("/")
    return fs.FileSystem.from_uri(path.rstrip("/"))


def folder_of(names: list[str], values: tuple) -> str:
    """``<name>=<value>/...``, named as Spark names partition folders."""
    escape = lambda text: ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text)
    return "/".join(f"{escape(n)}={escape(v) if v else NULL_FOLDER}" for n, v in zip(names, values, strict=True))


def write_file(store, path: str, content, packed: bool = False) -> None:
    if packed or store.type_name != "local":
        with store.open_output_stream(path, compression="gzip" if packed else None) as f:
            f.write(content)
        return
    out = os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o666)
    try:
        while len(content):
            content = content[os.write(out, content) :]
    finally:
        os.close(out)


@dataclass
class Staged(WriterCommitMessage):
    """What a task staged for each folder: how many files, and how many rows of
    a batch that is not whole."""

    task: str
    files: dict[str, int]
    rests: dict[str, int] = field(default_factory=dict)


class Batches:
    """Cuts a folder's texts, which end in their separators, into batches of
    ``size``; the first ``skip`` of them are kept apart, as ``head``."""

    def __init__(self, size: int, put, skip: int = 0):
        self.size, self.put, self.rest, self.rows, self.skip, self.head = size, put, b"", 0, skip, b""

    def add(self, texts) -> None:
        import numpy as np
        import pyarrow as pa

        if texts.null_count:
            raise ValueError("a row without a text")
        if not len(texts):
            return
        texts = texts.cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data, n = memoryview(texts.buffers()[2]), len(texts)
        at = min(self.skip, n)
        self.skip, self.head = self.skip - at, self.head + data[ends[0] : ends[at]]
        if self.rows:
            more = min(self.size - self.rows, n - at)
            self.rest, self.rows, at = self.rest + data[ends[at] : ends[at + more]], self.rows + more, at + more
            if self.rows < self.size:
                return
            self.put(self.rest)
        cuts = ends[at :: self.size].tolist()  # where batches begin, the last one perhaps not whole
        whole = (n - at) // self.size
        for start, end in zip(cuts[:whole], cuts[1 : whole + 1], strict=True):
            self.put(data[start:end])
        self.rest, self.rows = bytes(data[cuts[whole] : ends[n]]), n - at - whole * self.size


class BatchWriter(DataSourceArrowWriter):
    def __init__(
        self,
        path: str,
        names: list[str],
        size: int,
        arrays: bool,
        overwrite: bool,
        replace: bool,
        exact: bool = False,
        most: int = FOLDER_FILES,
        heads: dict[str, int] | None = None,
    ):
        self.heads = heads or {}
        self.path, self.names, self.size, self.arrays, self.exact, self.most = path, names, size, arrays, exact, most
        self.overwrite, self.replace, self.job = overwrite, replace, f"_landing-{uuid.uuid4().hex}"
        self.packed = size >= COMPRESS_FROM
        if exact and arrays:
            raise ValueError("exact batches are written as lines")

    def _name(self, task: str, n: int) -> str:
        return f"part-{task}-{n:06d}.{'json.gz' if self.packed else 'json'}"

    def _sub_folder(self, task: str, n: int) -> str:
        return f"{SUB_FOLDER}{task}-{(n - 1) // self.most:06d}"

    def _stage(self, store, root: str, task: str, files: dict[str, int], folder: str, content) -> None:
        n = files[folder] = files.get(folder, 0) + 1
        path = f"{root}/{self.job}/{folder}/{self._sub_folder(task, n)}"
        if (n - 1) % self.most == 0:
            store.create_dir(path, recursive=True)
        whole = b"".join((b"[", content[:-1], b"]")) if self.arrays else content
        write_file(store, f"{path}/{self._name(task, n)}", whole, self.packed)

    def _by_folder(self, batch):
        """(values of the partition columns, texts) of a batch's folders."""
        import numpy as np
        import pyarrow as pa

        texts, codes, values = batch.column(len(self.names)), np.zeros(batch.num_rows, dtype=np.int64), []
        for i in range(len(self.names)):
            column = batch.column(i).dictionary_encode(null_encoding="encode")
            codes = codes * len(column.dictionary) + column.indices.to_numpy()
            values.append(column.dictionary.to_pylist())
        found = np.unique(codes).tolist()
        for code in found:
            key, left = [], code
            for v in reversed(values):
                left, k = divmod(left, len(v))
                key.insert(0, v[k])
            yield tuple(key), texts if len(found) == 1 else texts.filter(pa.array(codes == code))

    def write(self, iterator):
        from pyspark import TaskContext

        store, root = open_store(self.path)
        number = TaskContext.get().partitionId()
        task, files, rests, opened, folders = uuid.uuid4().hex, {}, {}, {}, {}
        for batch in iterator:
            for key, texts in self._by_folder(batch):
                if key not in folders:
                    folder = folders[key] = folder_of(self.names, key)
                    if folder not in opened:
                        put = lambda content, to=folder: self._stage(store, root, task, files, to, content)
                        opened[folder] = Batches(self.size, put, self.heads.get(f"{number}/{folder}", 0))
                opened[folders[key]].add(texts)
        for folder, batches in opened.items():
            if self.exact and (batches.head or batches.rows):
                store.create_dir(f"{root}/{self.job}/{folder}", recursive=True)
                write_file(store, f"{root}/{self.job}/{folder}/rest-{task}", batches.head + batches.rest)
                rests[folder] = batches.rows
            elif batches.rows:
                batches.put(batches.rest)
        return Staged(task, files, rests)

    def _join_rests(self, store, root: str, done: list[Staged]) -> Staged:
        """The rows that tasks have over, at their beginnings and ends fewer than a
        batch each, joined in the order of the tasks: batches of ``size`` rows,
        and one rest a folder."""
        task, files = uuid.uuid4().hex, {}
        for folder in sorted({folder for m in done for folder in m.rests}):
            lines: list[bytes] = []
            for m in done:
                if folder in m.rests:
                    with store.open_input_stream(f"{root}/{self.job}/{folder}/rest-{m.task}", compression=None) as f:
                        lines += f.read().split(b"\n")[:-1]
                while len(lines) >= self.size:
                    self._stage(store, root, task, files, folder, b"\n".join(lines[: self.size]) + b"\n")
                    lines = lines[self.size :]
            if lines:
                self._stage(store, root, task, files, folder, b"\n".join(lines) + b"\n")
        return Staged(task, files)

    def _moves(self, store, done: list[Staged]):
        """(from, to) below the job's folder and the root: sub-folders of a folder
        with many files, single files otherwise."""
        count: dict[str, int] = {}
        for m in done:
            for folder, n in m.files.items():
                count[folder] = count.get(folder, 0) + n
        for m in done:
            for folder, n in m.files.items():
                at = f"{folder}/" if folder else ""
                if count[folder] > self.most and store.type_name in RENAMING:
                    for i in range(1, n + 1, self.most):
                        yield f"{at}{self._sub_folder(m.task, i)}", f"{at}{self._sub_folder(m.task, i)}"
                    continue
                for i in range(1, n + 1):
                    yield f"{at}{self._sub_folder(m.task, i)}/{self._name(m.task, i)}", f"{at}{self._name(m.task, i)}"

    def commit(self, messages):
        from pyarrow import fs

        store, root = open_store(self.path)
        store.create_dir(root, recursive=True)
        done = [m for m in messages if m is not None]
        done.append(self._join_rests(store, root, done))
        folders = {folder for m in done for folder in m.files}
        if self.overwrite:
            for found in store.get_file_info(fs.FileSelector(root)):
                if found.base_name != self.job:
                    (store.delete_dir if found.type == fs.FileType.Directory else store.delete_file)(found.path)
        for folder in folders:
            if self.replace:
                store.delete_dir_contents(f"{root}/{folder}", missing_dir_ok=True)
            store.create_dir(f"{root}/{folder}", recursive=True)
        moves = self._moves(store, done)
        with ThreadPoolExecutor(MOVERS) as pool:
            while some := list(islice(moves, FOLDER_FILES)):  # never all of them at once
                for _ in pool.map(lambda m: store.move(f"{root}/{self.job}/{m[0]}", f"{root}/{m[1]}"), some):
                    pass
        self._clear(store, root)

    def abort(self, messages):
        self._clear(*open_store(self.path))

    def _clear(self, store, root: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.job}")


class JsonBatches(DataSource):
    """Options: path; size (rows a file); arrays (true: a file is one array);
    replace (true: folders that the job writes are replaced, as a dynamic
    partition overwrite does); exact (true: all files of a folder but one hold
    ``size`` rows); heads (of exact batches: how many rows at a task's beginning
    belong to the batch that the task before it began, by ``<task>/<folder>``);
    most (files of a folder before they go to sub-folders).
    Texts end in the separator of their layout."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        flag = lambda name: self.options.get(name, "false") == "true"
        size, most = int(self.options["size"]), int(self.options["most"])
        names, flags = schema.names[:-1], (flag("arrays"), overwrite, flag("replace"), flag("exact"))
        return BatchWriter(self.options["path"], names, size, *flags, most, json.loads(self.options["heads"]))


def _heads(rows: DataFrame, names: list[str], size: int) -> dict[str, int]:
    """Rows are numbered through in every folder: a task's first number there is
    the count of the rows of earlier tasks. What is missing to a whole batch."""
    counts = rows.groupBy(F.spark_partition_id().alias("_part"), *names).agg(F.count("*").alias("_n"))
    heads: dict[str, int] = {}
    earlier: dict[str, int] = {}
    for part, *values, n in sorted(counts.collect(), key=lambda r: r["_part"]):  # a row a task and folder
        folder = folder_of(names, values)
        if missing := -earlier.get(folder, 0) % size:
            heads[f"{part}/{folder}"] = missing
        earlier[folder] = earlier.get(folder, 0) + n
    return heads


def write_batches(
    rows: DataFrame,
    path: str,
    size: int,
    mode: str = "append",
    arrays: bool = False,
    replace: bool = False,
    exact: bool = False,
) -> None:
    """Write (partition columns as text..., text) in files of at most ``size``
    rows; with ``exact``, of exactly ``size`` in all files of a folder but one,
    and of consecutive rows where ``rows`` gives the same rows in the same tasks
    when they are counted first (a table, or files)."""
    rows.sparkSession.dataSource.register(JsonBatches)
    *names, text = rows.columns
    rows = rows.select(*names, F.concat(text, F.lit("," if arrays else "\n")).alias(text))
    flags = {name: str(value).lower() for name, value in (("arrays", arrays), ("replace", replace), ("exact", exact))}
    heads = json.dumps(_heads(rows, names, size) if exact else {})
    rows.write.format(FORMAT).options(path=path, size=str(size), most=str(FOLDER_FILES), heads=heads, **flags).mode(mode).save()


# --- scan -----------------------------------------------------------------------


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(store, folder: str):
    """(name, whether it is a folder) of all that readers see in a folder."""
    if store.type_name == "local":
        with os.scandir(folder) as found:
            yield from ((e.name, e.is_dir()) for e in found if not _hidden(e.name))
        return
    from pyarrow import fs

    for found in store.get_file_info(fs.FileSelector(folder)):
        if not _hidden(found.base_name):
            yield found.base_name, found.type == fs.FileType.Directory


def scan_tasks(path: str, tasks: int) -> list[list[tuple[str, int, int]]]:
    """The folders below ``path`` dealt to about ``tasks`` tasks by their numbers
    of files: (folder, share, shares); a folder with more files than a task's is
    dealt to several, by its files' names."""
    store, root = open_store(path)
    count: dict[str, int] = {}
    left = [root]
    while left:
        folder, n = left.pop(), 0
        for name, is_folder in _entries(store, folder):
            if is_folder:
                left.append(f"{folder}/{name}")
            else:
                n += 1
        if n:
            count[folder] = n
    most = -(-sum(count.values()) // tasks)
    dealt: list[list[tuple[str, int, int]]] = []
    room = 0
    for folder in sorted(count):
        shares = -(-count[folder] // most)
        for share in range(shares):
            if room <= 0:
                dealt.append([])
                room = most
            dealt[-1].append((folder, share, shares))
            room -= count[folder] // shares
    return dealt


def _content(store, path: str) -> bytes:
    if store.type_name == "local" and path.endswith(".json"):
        with open(path, "rb", buffering=0) as f:
            content = f.read()
    else:
        with store.open_input_stream(path) as f:  # by its ending, what is compressed is unpacked
            content = f.read()
    encoding = json.detect_encoding(content[:4])  # as a JSON parser does
    return content if encoding == "utf-8" else content.decode(encoding).encode()


def scan(path: str, folders: list[tuple[str, int, int]]):
    """(path, content as UTF-8) of a task's files."""
    store, _ = open_store(path)
    for folder, share, shares in folders:
        for name, is_folder in _entries(store, folder):
            if not is_folder and (shares == 1 or zlib.crc32(name.encode()) % shares == share):
                yield f"{folder}/{name}", _content(store, f"{folder}/{name}")


def _dealt(spark: SparkSession, path: str):
    """An RDD with the folders of one task in each partition."""
    tasks = scan_tasks(path, SCAN_TASKS * parallelism(spark))
    return spark.sparkContext.parallelize(tasks, max(len(tasks), 1))


def read_texts(spark: SparkSession, path: str):
    """The content of every file below ``path``, an RDD of texts."""
    return _dealt(spark, path).flatMap(lambda folders: (content.decode(errors="replace") for _, content in scan(path, folders)))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): path and content of every file below ``path``."""
    import pyarrow as pa

    def scanned(batches):
        def batch():
            return pa.RecordBatch.from_arrays([pa.array(files), pa.array(contents, pa.binary())], ["file", "content"])

        files, contents, held = [], [], 0
        for tasks in batches:
            for folders in tasks.column(0).to_pylist():
                for file, content in scan(path, json.loads(folders)):
                    files.append(file)
                    contents.append(content)
                    held += len(content)
                    if len(files) == SCAN_FILES or held >= SCAN_BYTES:
                        yield batch()
                        files, contents, held = [], [], 0
        if files:
            yield batch()

    tasks = spark.createDataFrame(_dealt(spark, path).map(lambda folders: (json.dumps(folders),)), "folders string")
    found = tasks.mapInArrow(scanned, "file string, content binary")
    return found.select("file", F.col("content").cast("string").alias("text"))
