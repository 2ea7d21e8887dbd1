"""Landed ZIP archives holding CSV members, read in parallel by member; and the sink that writes such archives.

ZIP is not a Spark codec.  ``read_zip_csv`` is a Python data source: its partitions are the members found in the
archives' central directories (a few bytes of each archive), so an archive of many members is read by many tasks, and a
task streams one member: it opens the archive at its path, inflates the member as it reads and hands parsed rows on in
Arrow batches of about ``BLOCK`` bytes of text.  Neither an archive nor a member is ever held whole.

Paths are files or globs on a file system that driver and executors share (``file:`` or none), or any URI that
``pyarrow.fs`` opens.
"""

from __future__ import annotations

import fnmatch
import glob
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.nulls import normalise_nan

BLOCK = 1 << 20
#: Cells read as missing (fixed values).
MISSING = ["", "NaN", "nan", "NA", "N/A", "null", "NULL"]


def local_path(path: str) -> str | None:
    """The path of a local or shared file, None for other file systems."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def zip_csv_source() -> type:
    """The data source class.  It is made here, so that Spark sends it to its workers by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    blocks, missing, plain = BLOCK, MISSING, local_path

    def opened(path: str):
        own = plain(path)
        if own is not None:
            return open(own, "rb")
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        return system.open_input_file(at)

    def listed(pattern: str) -> list[str]:
        own = plain(pattern)
        if own is not None:
            if os.path.isdir(own):
                own = os.path.join(own, "*.zip")
            return sorted(glob.glob(own))
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(pattern.split("*")[0].rsplit("/", 1)[0])
        found = system.get_file_info(fs.FileSelector(at, recursive=True))
        head = pattern.split("://")[0] + "://"
        return sorted(head + f.path for f in found if f.is_file and fnmatch.fnmatch(head + f.path, pattern))

    class Member(InputPartition):
        def __init__(self, path: str, member: str):
            self.path, self.member = path, member

    class Reader(DataSourceReader):
        def __init__(self, schema, options):
            self.columns, self.options = [f.name for f in schema.fields], dict(options)

        def partitions(self):
            pattern, out = self.options.get("memberglob", "*.csv"), []
            for path in listed(self.options["path"]):
                with opened(path) as fh, zipfile.ZipFile(fh) as archive:
                    out += [Member(path, m.filename) for m in archive.infolist() if not m.is_dir() and fnmatch.fnmatch(m.filename, pattern)]
            return out

        def read(self, partition):
            import pyarrow as pa
            import pyarrow.compute as pc
            from pyarrow import csv

            if not isinstance(partition, Member):  # no archive: Spark asks for one empty partition
                return
            names, zone = self.columns[:-1], (self.options.get("zonecolumn"), self.options.get("zone"))
            with opened(partition.path) as fh, zipfile.ZipFile(fh) as archive, archive.open(partition.member) as member:
                try:
                    rows = csv.open_csv(pa.PythonFile(member, mode="r"), csv.ReadOptions(block_size=blocks), csv.ParseOptions(newlines_in_values=True),
                                        csv.ConvertOptions(column_types={n: pa.string() for n in names}, include_columns=names,
                                                           include_missing_columns=True, null_values=missing, strings_can_be_null=True))
                except pa.ArrowInvalid as e:
                    if "Empty CSV file" in str(e):
                        return
                    raise
                for batch in rows:
                    if zone[0] is not None and zone[1] is not None:
                        batch = batch.filter(pc.equal(batch.column(zone[0]), zone[1]))
                    source = pa.array([f"{partition.path}!{partition.member}"] * len(batch), pa.string())
                    yield pa.RecordBatch.from_arrays([*batch.columns, source], self.columns)

    class ZipCsv(DataSource):
        @classmethod
        def name(cls):
            return "zipcsv"

        def reader(self, schema):
            return Reader(schema, self.options)

    return ZipCsv


def read_zip_csv(spark: SparkSession, path: str, schema: StructType, *, member_glob: str = "*.csv",
                 zone_col: str | None = None, zone: str | None = None, source_col: str = "source_member") -> DataFrame:
    """Every CSV member of every archive under ``path`` (a folder, or a glob such as ``landing/*.zip``), one task each;
    rows of one ``zone`` only, if given.  Columns a member lacks are NULL, further ones are not read."""
    spark.dataSource.register(zip_csv_source())
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(source_col, StringType())])
    rd = spark.read.format("zipcsv").schema(text).option("memberGlob", member_glob)
    if zone_col is not None and zone is not None:
        rd = rd.option("zoneColumn", zone_col).option("zone", zone)
    typed = rd.load(path).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields], F.col(f"`{source_col}`"))
    return normalise_nan(typed)


def write_zip_csv(df: DataFrame, folder: str, archive: str, member: str) -> int:
    """Write headered CSV archives ``<archive>.zip`` of members ``<member>.csv`` into a shared folder, named by the
    values of two text columns; the other columns are the content (Spark's text form, NULL empty).  Rows meet by
    archive and stream, sorted by member, into the archive, which gets its name when it is whole: a repeated task
    replaces it by an equal one.  Returns the number of archives."""
    import csv
    import io
    import uuid

    names = [c for c in df.columns if c not in (archive, member)]
    target = local_path(folder)
    if target is None:
        raise ValueError("archives are written to a folder that all executors share as files")

    def write(batches):
        import pandas as pd

        os.makedirs(target, exist_ok=True)
        now, part, out, sink, written = None, None, None, None, []

        def close():
            if sink is not None:
                sink.close()
            if out is not None:
                out.close()
                os.replace(part, os.path.join(target, now[0] + ".zip"))
                written.append(now[0])

        for pdf in batches:
            for key, rows in pdf.groupby([archive, member], sort=False):
                if now is None or key[0] != now[0]:
                    close()
                    part = os.path.join(target, f".{uuid.uuid4().hex}.part")
                    out, sink = zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED), None
                if sink is None or key != now:
                    if sink is not None:
                        sink.close()
                    sink = out.open(key[1] + ".csv", "w", force_zip64=True)
                    sink.write((",".join(f'"{n}"' for n in names) + "\n").encode())
                now = key
                text = io.StringIO()
                csv.writer(text, lineterminator="\n").writerows(rows[names].fillna("").itertuples(index=False))
                sink.write(text.getvalue().encode())
        close()
        yield pd.DataFrame({"archive": written})

    rows = df.select(F.col(f"`{archive}`").alias(archive), F.col(f"`{member}`").alias(member), *[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    rows = rows.where(F.col(archive).isNotNull() & F.col(member).isNotNull()).repartition(archive).sortWithinPartitions(archive, member)
    return rows.mapInPandas(write, "archive string").count()
