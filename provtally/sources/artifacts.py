"""Release artifacts as files: one document per path below a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a file that a task holds at a time.
BLOCK = 8 << 20


def _uri(spark: SparkSession, root: str) -> str:
    """Where the session's file systems place a root, so that tasks write where readers look."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    scheme, _, rest = whole.partition(":")
    # Local names come with one slash, and object stores under their connector's scheme.
    return f"file://{rest}" if scheme == "file" and not rest.startswith("//") else f"{scheme.replace('s3a', 's3')}:{rest}"


def read_artifacts(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, content) of every file below a root, with the raw bytes kept for digesting.

    ``pattern`` is a glob below the root; files outside it are not opened. A pattern that matches
    nothing gives no rows.
    """
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is None:
        files = reader.load(base)
    else:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        if len(fs.globStatus(hadoop_path) or []) == 0:
            return spark.createDataFrame([], "path string, content binary")
        files = reader.load(f"{base}/{pattern}")
    # Scheme and authority differ between the given root and the listed files; the root's own path does not.
    plain = base.split("://", 1)[1] if "://" in base else base.removeprefix("file:")
    plain = plain[plain.index("/"):] if "://" in base and not base.startswith("file:") else plain
    below = F.expr(f"substring(path, locate('{plain}/', path) + {len(plain) + 1})")
    return files.select(below.alias("path"), "content")


def write_artifacts(documents: DataFrame, root: str) -> int:
    """Write each (path, body) row as one UTF-8 file; returns how many were written.

    Tasks write their own files under a temporary name and rename them, so a task that is run
    again after a lost executor leaves the same files behind.
    """
    target = _uri(documents.sparkSession, root)

    # Defined here, so that it travels to the executors by value.
    def write_batches(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(target)
        made = set()
        for batch in batches:
            written = 0
            for path, body in zip(batch.column("path").to_pylist(), batch.column("body").to_pylist(), strict=True):
                final = f"{base}/{path}"
                folder = final.rsplit("/", 1)[0]
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with filesystem.open_output_stream(draft) as out:
                    out.write(body.encode("utf-8"))
                filesystem.move(draft, final)
                written += 1
            yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int64())})

    counts = documents.select("path", "body").mapInArrow(write_batches, "written bigint")
    return counts.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]


def digest_file(spark: SparkSession, root: str, path: str) -> str:
    """Digest of one file below a root, read in blocks by a task."""
    target, block_size = _uri(spark, root), BLOCK

    def digest(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs as pafs

        for _ in batches:
            filesystem, base = pafs.FileSystem.from_uri(target)
            hashed = hashlib.sha256()
            with filesystem.open_input_stream(f"{base}/{path}") as source:
                while block := source.read(block_size):
                    hashed.update(block)
            yield pa.RecordBatch.from_pydict({"digest": [hashed.hexdigest()]})

    return "sha256:" + spark.range(0, 1, 1, 1).mapInArrow(digest, "digest string").first()[0]


def join_fragments(spark: SparkSession, folder: str, root: str, path: str, head: str, tail: str, skip: int = 0) -> str:
    """Write head, the text files of a folder in the order of their names, and tail as one file; returns its digest.

    A task copies block by block, under a temporary name until all is written. The first ``skip`` bytes of the
    files are left out.
    """
    source_at, target, block_size = _uri(spark, folder), _uri(spark, root), BLOCK

    def join(batches):
        import hashlib
        import uuid

        import pyarrow as pa
        from pyarrow import fs as pafs

        for _ in batches:
            filesystem, base = pafs.FileSystem.from_uri(target)
            sources, named = pafs.FileSystem.from_uri(source_at)
            final = f"{base}/{path}"
            within = final.rsplit("/", 1)[0]
            filesystem.create_dir(within, recursive=True)
            draft, hashed, left = f"{within}/.{uuid.uuid4().hex}", hashlib.sha256(), skip
            files = sorted(f.path for f in sources.get_file_info(pafs.FileSelector(named)) if f.base_name.startswith("part-"))
            with filesystem.open_output_stream(draft) as out:

                def put(block):
                    out.write(block)
                    hashed.update(block)

                put(head.encode("utf-8"))
                for name in files:
                    with sources.open_input_stream(name) as source:
                        while block := source.read(block_size):
                            put(block[left:])
                            left = max(0, left - len(block))
                put(tail.encode("utf-8"))
            filesystem.move(draft, final)
            yield pa.RecordBatch.from_pydict({"digest": [hashed.hexdigest()]})

    return "sha256:" + spark.range(0, 1, 1, 1).mapInArrow(join, "digest string").first()[0]
