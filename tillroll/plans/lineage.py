"""Cutting lineage: reliable checkpoints and written intermediate tables.

Both land in the shared folder named by ``spark.checkpoint.dir`` (see
:func:`tillroll.session.ensure_checkpoint_dir`), so a lost executor re-reads
the files instead of recomputing, and nothing depends on a machine-local
folder.
"""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import ensure_checkpoint_dir, scratch_path


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Use for a cleaned table that several later jobs scan: they then read
    columnar files with pushdown instead of re-running the cleaning plan."""
    return Scratch(df.sparkSession).table(df, name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer (any store)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_made: ContextVar[list | None] = ContextVar("made", default=None)


@contextmanager
def released():
    """Deletes, at the end, every table that a :class:`Scratch` made inside
    has not dropped by then. Write what is wanted to a Scratch from outside."""
    made: list[Scratch] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for scratch in made:
            scratch.close()


class Scratch:
    """Written intermediate tables of one program run, deletable one by one.

    ``table`` writes a frame under the checkpoint folder and returns the
    frame that reads it; ``drop`` deletes the files of such a frame once no
    later job reads it; ``close`` deletes the rest (also on leaving a
    ``with`` block).
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[DataFrame, str] = {}
        if (made := _made.get()) is not None:
            made.append(self)

    def table(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        writer = df.write.mode("overwrite")
        (writer.option("compression", compression) if compression else writer).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[back] = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete_path(self.spark, self.paths.pop(table))

    def close(self) -> None:
        self.drop(*list(self.paths))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
