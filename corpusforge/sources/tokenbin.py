"""``tokenbin``: headerless little-endian uint16 token files.

Writer: every task writes its partition's ids, in row order, to one shard
``part-<partition>-<uuid>.bin``; ids above 65535 are rejected, never
wrapped.  On commit the driver receives one small message per shard and
writes ``_manifest.json`` with each shard's global start offset, so the
shards form one stream in partition order (range-partition by the order key
before writing).  No token passes through the driver.

Reader: each shard is cut into byte ranges of ``partition_tokens`` tokens;
each range is one input partition, read with positioned reads and returned
as rows ``shard, offset, ids`` of at most ``chunk_tokens`` ids in Arrow batches.
Filters on ``offset`` are pushed down: ranges they leave out are not read.

``tokenseq`` reads the same files as training sequences (C4) by position, with
filters on ``seq_id`` pushed down.

Paths go through ``pyarrow.fs``: local paths, or URIs of any filesystem
pyarrow was built with (``hdfs://``, ``s3://``, ...), so executors write to
and read from the cluster's shared storage.  A path without a scheme is
local to each machine here; ``shared_path`` qualifies it on the driver with the
file system Spark's own writers would use.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
                                    WriterCommitMessage)

MAX_ID = 65535
MANIFEST = "_manifest.json"


def _fs(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    import os

    return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))


class _Range(InputPartition):
    def __init__(self, shard: str, start: int, stop: int, base: int):
        self.shard, self.start, self.stop, self.base = shard, start, stop, base


class _Shard(WriterCommitMessage):
    def __init__(self, partition: int, name: str, n_tokens: int):
        self.partition, self.name, self.n_tokens = partition, name, n_tokens


def _shards(path: str) -> list[tuple[str, int, int]]:
    """``(shard path, global start, n_tokens)`` in stream order."""
    from pyarrow import fs

    filesystem, root = _fs(path)
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(root, 0, info.size // 2)]
    man = f"{root}/{MANIFEST}"
    if filesystem.get_file_info(man).type == fs.FileType.File:
        with filesystem.open_input_stream(man) as f:
            rows = json.loads(f.read().decode("utf-8"))["shards"]
        return [(f"{root}/{s['name']}", s["start"], s["n_tokens"]) for s in rows]
    files = sorted((i for i in filesystem.get_file_info(fs.FileSelector(root))
                    if i.path.endswith(".bin") and not i.base_name.startswith("_")), key=lambda i: i.path)
    out, start = [], 0
    for i in files:
        out.append((i.path, start, i.size // 2))
        start += i.size // 2
    return out


def _bounds(filters, column: str) -> tuple[int, float, list]:
    """``[lo, hi)`` that the filters leave for an integer column, and those
    filters that are not told by it."""
    lo, hi, rest = 0, float("inf"), []
    for f in filters:
        mine = getattr(f, "attribute", None) == (column,)
        v = getattr(f, "value", None)
        if mine and isinstance(f, EqualTo) and isinstance(v, int):
            lo, hi = max(lo, v), min(hi, v + 1)
        elif mine and isinstance(f, GreaterThan):
            lo = max(lo, v + 1)
        elif mine and isinstance(f, GreaterThanOrEqual):
            lo = max(lo, v)
        elif mine and isinstance(f, LessThan):
            hi = min(hi, v)
        elif mine and isinstance(f, LessThanOrEqual):
            hi = min(hi, v + 1)
        elif mine and isinstance(f, In) and f.value:
            lo, hi = max(lo, min(f.value)), min(hi, max(f.value) + 1)
            rest.append(f)
        elif not (mine and isinstance(f, IsNotNull)):
            rest.append(f)
    return lo, hi, rest


def _lists(values, sizes):
    """Consecutive ``sizes`` of ``values`` as an Arrow list column."""
    import numpy as np
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


class TokenBinReader(DataSourceReader):
    """Rows ``shard, offset, ids``; a filter on ``offset`` leaves out whole byte ranges."""

    def __init__(self, options):
        self.path = options["path"]
        self.chunk_tokens = int(options.get("chunk_tokens", 1 << 16))
        # ranges start at multiples of a row's tokens
        self.partition_tokens = -(-int(options.get("partition_tokens", 1 << 24)) // self.chunk_tokens) * self.chunk_tokens
        self.lo, self.hi = 0, float("inf")

    def pushFilters(self, filters):
        self.lo, self.hi, _ = _bounds(filters, "offset")
        return filters

    def partitions(self):
        parts, chunk = [], self.chunk_tokens
        for shard, base, n in _shards(self.path):
            # rows of this shard start at base + k * chunk
            first = max(0, -(-(self.lo - base) // chunk)) * chunk
            stop = n if self.hi == float("inf") else min(n, max(0, -(-(self.hi - base) // chunk)) * chunk)
            for s in range(first, stop, self.partition_tokens):
                parts.append(_Range(shard, s, min(stop, s + self.partition_tokens), base))
        return parts or [_Range("", 0, 0, 0)]

    def read(self, partition: _Range):
        import numpy as np
        import pyarrow as pa

        if partition.stop <= partition.start:
            return
        filesystem, _ = _fs(self.path)
        name, chunk = partition.shard.rsplit("/", 1)[-1], self.chunk_tokens
        step = max(1, (1 << 20) // chunk) * chunk
        with filesystem.open_input_file(partition.shard) as f:
            for s in range(partition.start, partition.stop, step):
                arr = np.frombuffer(f.read_at(min(step, partition.stop - s) * 2, s * 2), dtype="<u2")
                at = np.arange(0, len(arr), chunk)
                sizes = np.diff(np.append(at, len(arr)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(partition.base + s + at), _lists(arr, sizes)],
                                                 names=["shard", "offset", "ids"])


class _Sequences(InputPartition):
    def __init__(self, first: int, stop: int):
        self.first, self.stop = first, stop


class TokenSeqReader(DataSourceReader):
    """C4 from the packed file: sequence ``i`` holds the ``length + 1`` tokens from
    ``i * stride`` on, read by position; a partition is a range of sequences, whose
    bytes overlap the next one's by ``length`` tokens, and may span shards."""

    def __init__(self, options):
        self.path = options["path"]
        self.length = int(options["length"])
        self.stride = int(options.get("stride", 0)) or self.length
        self.partition_tokens = int(options.get("partition_tokens", 1 << 22))
        self.lo, self.hi = 0, float("inf")

    def pushFilters(self, filters):
        self.lo, self.hi, rest = _bounds(filters, "seq_id")
        return rest

    def partitions(self):
        shards = _shards(self.path)
        total = sum(n for _, _, n in shards)
        count = max(0, (total - self.length - 1) // self.stride + 1)
        first, stop = min(self.lo, count), min(self.hi, count)
        each = max(1, self.partition_tokens // self.stride)
        return [_Sequences(s, min(stop, s + each)) for s in range(first, stop, each)] or [_Sequences(0, 0)]

    def _tokens(self, filesystem, shards, start: int, stop: int):
        import numpy as np

        out = []
        for path, base, n in shards:
            s, e = max(start, base), min(stop, base + n)
            if s < e:
                with filesystem.open_input_file(path) as f:
                    out.append(np.frombuffer(f.read_at((e - s) * 2, (s - base) * 2), dtype="<u2"))
        return np.concatenate(out)

    def read(self, partition: _Sequences):
        import numpy as np
        import pyarrow as pa

        filesystem, _ = _fs(self.path)
        shards = _shards(self.path) if partition.first < partition.stop else []
        L, S = self.length, self.stride
        each = max(1, (1 << 20) // (L + 1))
        for s in range(partition.first, partition.stop, each):
            e = min(partition.stop, s + each)
            flat = self._tokens(filesystem, shards, s * S, (e - 1) * S + L + 1)
            tokens = flat[(np.arange(e - s) * S)[:, None] + np.arange(L + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(s, e)), _lists(tokens[:, :-1].ravel(), np.full(e - s, L)),
                 _lists(tokens[:, 1:].ravel(), np.full(e - s, L))], names=["seq_id", "input_ids", "target_ids"])


class TokenBinWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.column = options.get("column", "ids")
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex  # names the files of this write

    def write(self, iterator) -> _Shard:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        filesystem, root = _fs(self.path)
        filesystem.create_dir(root, recursive=True)
        name = f"part-{pid:05d}-{self.job}-{uuid.uuid4().hex}.bin"
        tmp = f"{root}/_tmp-{name}"
        n = 0
        with filesystem.open_output_stream(tmp) as f:
            for batch in iterator:
                vals = pc.list_flatten(batch.column(self.column)).to_numpy(zero_copy_only=False)
                if len(vals) and (vals.max() > MAX_ID or vals.min() < 0):
                    raise ValueError(f"token id outside uint16 range in partition {pid}")
                f.write(vals.astype("<u2").tobytes())
                n += len(vals)
        filesystem.move(tmp, f"{root}/{name}")
        return _Shard(pid, name, n)

    def commit(self, messages) -> None:
        shards = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        filesystem, root = _fs(self.path)
        before = self._manifest(filesystem, root)
        rows = [] if self.overwrite else list(before)  # append: the stream goes on behind what is there
        start = sum(r["n_tokens"] for r in rows)
        for m in shards:
            rows.append({"name": m.name, "partition": len(rows), "n_tokens": m.n_tokens, "start": start})
            start += m.n_tokens
        with filesystem.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"n_tokens": start, "shards": rows}).encode("utf-8"))
        if self.overwrite:
            self._delete(filesystem, [f"{root}/{r['name']}" for r in before])

    @staticmethod
    def _manifest(filesystem, root) -> list[dict]:
        try:
            with filesystem.open_input_stream(f"{root}/{MANIFEST}") as f:
                return json.loads(f.read())["shards"]
        except FileNotFoundError:
            return []

    @staticmethod
    def _delete(filesystem, paths) -> None:
        for p in paths:
            try:
                filesystem.delete_file(p)
            except OSError:
                pass

    def abort(self, messages) -> None:
        """Remove every file of this write, temporary ones of failed tasks too."""
        from pyarrow.fs import FileSelector

        filesystem, root = _fs(self.path)
        found = filesystem.get_file_info(FileSelector(root, allow_not_found=True))
        self._delete(filesystem, [f.path for f in found if self.job in f.base_name])


class TokenBinDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tokenbin"

    def schema(self) -> str:
        return "shard string, offset bigint, ids array<int>"

    def reader(self, schema) -> TokenBinReader:
        return TokenBinReader(self.options)

    def writer(self, schema, overwrite: bool) -> TokenBinWriter:
        return TokenBinWriter(self.options, overwrite)


class TokenSeqDataSource(DataSource):
    """Training sequences straight from ``tokenbin`` shards: options ``path``,
    ``length`` and ``stride`` (0: the length)."""

    @classmethod
    def name(cls) -> str:
        return "tokenseq"

    def schema(self) -> str:
        return "seq_id bigint, input_ids array<int>, target_ids array<int>"

    def reader(self, schema) -> TokenSeqReader:
        return TokenSeqReader(self.options)


def shared_path(spark, path: str) -> str:
    """``path`` with the scheme of Spark's default file system if it has none."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString()


def register(spark) -> None:
    """Make the formats ``tokenbin`` and ``tokenseq`` known, with filter pushdown
    (Spark refuses a reader that takes filters while its setting is off)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenBinDataSource)
    spark.dataSource.register(TokenSeqDataSource)
