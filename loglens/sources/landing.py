"""Landing-folder ingest: the data effect of the reference's upload service.

Instead of an HTTP endpoint that streams uploads into HDFS, files are dropped into
a landing folder and Spark picks them up: as a stream (S7), as a manifest of what
landed (S8), and, for zip archives, as the lines of every member (S9).
"""

from __future__ import annotations

import io
import posixpath
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import qualify


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                   clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """New text files in ``landing_dir`` become streaming rows ``value``.

    ``clean_source='archive'|'delete'`` moves or removes files once committed, which
    keeps the listing small on a long-running landing folder.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.load(landing_dir)


def landing_manifest(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Name, size and modification time of every landed file.

    ``binaryFile`` with only metadata columns selected: the file contents are
    pruned and never read. Hidden files (``_SUCCESS``, ``.crc``) are skipped.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing_dir)
            .select(F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                    F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified")))


# ---- archives ---------------------------------------------------------------------

def _open_binary(path: str):
    """Open a file for reading on an executor: local paths directly, any other
    filesystem through pyarrow (HDFS, S3, GCS)."""
    if path.startswith("file:"):
        p = path[5:]
        while p.startswith("//"):
            p = p[1:]
        return open(p, "rb")
    if "://" not in path:
        return open(path, "rb")
    filesystem, inner = _arrow_fs(path)
    return filesystem.open_input_file(inner)


def _arrow_fs(uri: str):
    """pyarrow's filesystem and inner path; Hadoop's names for S3 are mapped to pyarrow's."""
    from pyarrow import fs as pafs
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


MEMBER_SCHEMA = T.StructType([T.StructField("archive_path", T.StringType()),
                              T.StructField("member", T.StringType()),
                              T.StructField("member_size", T.LongType())])
LINE_SCHEMA = T.StructType([T.StructField("archive", T.StringType()), T.StructField("member", T.StringType()),
                            T.StructField("line_no", T.LongType()), T.StructField("value", T.StringType()),
                            T.StructField("archive_path", T.StringType()),
                            T.StructField("member_path", T.StringType())])


def _list_members(it):
    for pdf in it:
        rows = []
        for path in pdf["path"]:
            with _open_binary(path) as fh, zipfile.ZipFile(fh) as zf:   # reads the central directory only
                for info in zf.infolist():
                    if info.is_dir():
                        continue
                    rows.append((path, info.filename, int(info.file_size)))
        yield pd.DataFrame(rows, columns=["archive_path", "member", "member_size"])


def _read_members(batch_rows: int):
    def fn(it):
        for pdf in it:
            for path, member in zip(pdf["archive_path"], pdf["member"]):
                arch, base = posixpath.basename(path), posixpath.basename(member)
                buf, n = [], 0
                with _open_binary(path) as fh, zipfile.ZipFile(fh) as zf, zf.open(member) as mf:
                    for raw in mf:
                        n += 1
                        line = raw.rstrip(b"\n")
                        if line.endswith(b"\r"):
                            line = line[:-1]
                        buf.append((arch, base, n, line.decode("utf-8", errors="replace"), path, member))
                        if len(buf) >= batch_rows:
                            yield pd.DataFrame(buf, columns=LINE_SCHEMA.names)
                            buf = []
                if buf:
                    yield pd.DataFrame(buf, columns=LINE_SCHEMA.names)
    return fn


#: Bytes of members for each task, about.
MEMBER_BYTES = 128 << 20


def archive_ingest(spark: SparkSession, pattern: str, partitions: int | None = None,
                   batch_rows: int = 20000) -> DataFrame:
    """Every regular member of every zip archive -> rows ``(archive, member, line_no, value)``.

    Directory entries are skipped and member names reduced to their base name; the full
    paths are in ``archive_path`` and ``member_path``, which tell equal base names apart. Only
    archive *paths* travel through Spark (``binaryFile`` with content pruned): a task
    lists each archive's central directory, members are spread over tasks, and each
    member is streamed line by line on an executor, so no archive or member is ever
    held in memory whole and archives over 2 GB work.
    """
    paths = spark.read.format("binaryFile").load(pattern).select("path")
    members = paths.mapInPandas(_list_members, MEMBER_SCHEMA)
    n = partitions
    if not n:       # from the members' sizes, which the central directories list
        n_bytes = members.agg(F.sum("member_size")).first()[0] or 0
        n = max(spark.sparkContext.defaultParallelism, -(-n_bytes // MEMBER_BYTES))
    members = members.repartition(n, "archive_path", "member")
    return members.mapInPandas(_read_members(batch_rows), LINE_SCHEMA)


def _write_bytes(target: str, data: bytes) -> None:
    """Write a whole small file from an executor: local paths directly, others via pyarrow."""
    if target.startswith("file:") or "://" not in target:
        import os
        local = target[5:] if target.startswith("file:") else target
        while local.startswith("//"):
            local = local[1:]
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as fh:
            fh.write(data)
        return
    filesystem, inner = _arrow_fs(target)
    with filesystem.open_output_stream(inner) as out:
        out.write(data)


def _write_zip_fn(root: str, members_col: str):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        name = f"{pdf['day'].iloc[0]}-{int(pdf['block'].iloc[0]):05d}.zip"
        target = f"{root.rstrip('/')}/{name}"
        pdf = pdf.sort_values("event_id")
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("logs/", b"")
            for member, g in pdf.groupby(members_col, sort=True):
                zf.writestr(f"logs/{member}.log", ("\n".join(g["value"]) + "\n").encode("utf-8"))
        _write_bytes(target, buf.getvalue())
        return pd.DataFrame({"archive": [name], "n_lines": [len(pdf)]})
    return fn


# Stand-in archives hold at most this many events each, so no task builds more than one
# bounded archive in memory.
ARCHIVE_BLOCK = 100_000


def write_day_archives(lines: DataFrame, root: str, members_col: str = "event_type",
                       block: int = ARCHIVE_BLOCK) -> DataFrame:
    """Stand-in archives: one zip per (day, block of ``block`` event ids), each with a
    ``logs/`` folder entry and one member per ``members_col`` value, lines in
    ``event_id`` order. Test input only."""
    root = qualify(lines.sparkSession, root)    # a path without a scheme may be on HDFS
    df = lines.select(F.date_format("ts", "yyyy-MM-dd").alias("day"),
                      F.floor(F.col("event_id") / block).alias("block"), "event_id", members_col, "value")
    return df.groupBy("day", "block").applyInPandas(_write_zip_fn(root, members_col),
                                                     "archive string, n_lines long")
