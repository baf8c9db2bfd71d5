"""Tables and peptides as text: a writer whose parts appear together or not at all, and readers that know what counts as missing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Texts that stand for nothing in a table, and letters of a FASTA line. Fixed values.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
WIDTH = 60


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


class TextTableSink(DataSource):
    """spark.dataSource.register(TextTableSink); df.write.format("text_table").mode("overwrite").save(path).

    Tab-separated parts with a header each, null as option ``na`` (NA), true and false in lower case, tabs and line ends
    in text as blanks. Option kind=fasta writes columns id and sequence as records of 60 letters a line; null sequences
    go. Tasks write aside; only when all are done are their parts moved to the folder and _SUCCESS written. A job that
    fails leaves what was there before; a task that still runs then may leave its part aside (_staged-*, which readers
    pass over). Without overwrite a folder that has a result is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "text_table"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return TextTableWriter(self.options["path"], schema.names, self.options.get("kind", "table"), self.options.get("na", "NA"), overwrite)


class TextTableWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str], kind: str, na: str, overwrite: bool):
        if kind not in ("table", "fasta"):
            raise ValueError(f"kind must be table or fasta, not {kind!r}")
        if kind == "fasta" and set(names) != {"id", "sequence"}:
            raise ValueError("a fasta has columns id and sequence")
        self.path, self.names, self.kind, self.na, self.overwrite = path, names, kind, na, overwrite
        self.aside = f"_staged-{uuid.uuid4().hex}"

    def _store(self):
        from .bgzf import filesystem

        return filesystem(self.path)

    def _lines(self, rows: Iterator[Row]) -> Iterator[tuple[int, str]]:
        """(1 for a row or 0, line)"""
        if self.kind == "table":
            yield 0, "\t".join(self.names)
        for r in rows:
            if self.kind == "table":
                yield 1, "\t".join(self._cell(r[c]) for c in self.names)
            elif r["sequence"] is not None:
                yield 1, f">{self._cell(r['id'])}"
                for k in range(0, len(r["sequence"]), WIDTH):
                    yield 0, r["sequence"][k : k + WIDTH]

    def _cell(self, value: object) -> str:
        if value is None:
            return self.na
        if isinstance(value, bool):
            return str(value).lower()
        return str(value).translate({9: " ", 10: " ", 13: " "})

    def write(self, iterator: Iterator[Row]) -> Part:
        store, folder = self._store()
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.{'tsv' if self.kind == 'table' else 'fa'}"
        store.create_dir(f"{folder}/{self.aside}", recursive=True)
        n = 0
        with store.open_output_stream(f"{folder}/{self.aside}/{name}") as out:
            for count, line in self._lines(iterator):
                n += count
                out.write(line.encode() + b"\n")
        return Part(name, n)

    def _there(self, store, folder: str) -> list[str]:
        from pyarrow import fs

        return [i.path for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.type == fs.FileType.File]

    def commit(self, messages: list[Part | None]) -> None:
        store, folder = self._store()
        held = self._there(store, folder)
        if held and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"there is a result in {self.path}")
        store.create_dir(folder, recursive=True)
        for p in held:
            store.delete_file(p)
        for m in messages:
            if m is not None:
                store.move(f"{folder}/{self.aside}/{m.name}", f"{folder}/{m.name}")
        self.abort(messages)
        with store.open_output_stream(f"{folder}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = self._store()
        try:
            store.delete_dir(f"{folder}/{self.aside}")
        except FileNotFoundError:  # no task has begun
            pass


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A tab-separated table with a header; what stands for nothing is null. With a schema, values that don't parse are null too."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    known = StructType.fromDDL(schema) if schema else None
    value = lambda c: F.when(~F.trim(f"`{c}`").isin(MISSING), F.col(f"`{c}`"))
    if known is None:
        return raw.select(*[value(c).alias(c) for c in raw.columns])
    return raw.select(*[(value(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in known])


def read_peptides(spark: SparkSession, path: str) -> DataFrame:
    """locus_id, transcript_id, aa and sequence of FASTA records named locus|transcript|aa; records are split at their mark, so files of any size take many tasks."""
    records = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    name = F.split(F.regexp_extract("value", r"^([^\n]*)", 1), r"\|")
    sequence = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(F.trim(name[0]).alias("locus_id"), F.get(name, F.lit(1)).alias("transcript_id"), F.get(name, F.lit(2)).try_cast("int").alias("aa"), sequence.alias("sequence"))
