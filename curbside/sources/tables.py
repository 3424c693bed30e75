"""Versioned tables over plain Parquet folders.

`<root>/<table>/_batch=<n>/` holds one immutable batch; `<root>/_commits/` holds one small row per
version that lists the batches it consists of. Readers name the batches they want, so an older
version stays readable after any later write. One writer per table; no concurrency is claimed.

A table partitioned by one column can have some of its values replaced: the new batch holds these values whole, the
commit names them, and what older batches have of them is pruned as partitions when the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbside.sources.layout import one_of, spread_for

COMMITS = (
    "table_name string, version int, op string, batches array<int>, columns array<string>, "
    "column_types array<string>, n_rows bigint, added_rows bigint, next_batch int, committed_at timestamp, "
    "replaced array<string>"
)
_COMMIT_FIELDS = [part.split(" ")[0] for part in COMMITS.split(", ")]


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name
        self.partition_by = list(partition_by)

    # -- metadata ---------------------------------------------------------------------------

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}"

    def history(self) -> DataFrame:
        """All versions of this table, one row each."""
        return read_if_exists(self.spark, f"{self.root}/_commits", COMMITS).where(F.col("table_name") == self.name)

    def commit(self, version: int | None = None) -> Row | None:
        """The commit row of a version, the latest by default; None if there is none."""
        history = self.history()
        if version is not None:
            history = history.where(F.col("version") == version)
        return history.orderBy(F.desc("version")).first()

    def exists(self) -> bool:
        return self.commit() is not None

    def require(self, version: int | None = None) -> Row:
        found = self.commit(version)
        if found is None:
            which = "" if version is None else f" version {version}"
            raise RuntimeError(f"table {self.name}{which} not found below {self.root}")
        return found

    def latest_version(self) -> int:
        return self.require().version

    # -- reads ------------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (latest by default); columns a batch lacks are NULL."""
        return self.rows_of(self.require(version))

    def rows_of(self, commit: Row, batches: Sequence[int] | None = None) -> DataFrame:
        """Some batches of a commit, all by default, under the commit's schema."""
        schema = StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in zip(commit.columns, commit.column_types)))
        paths = [f"{self.path}/_batch={n}" for n in (commit.batches if batches is None else batches)]
        stored = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        for batch, values in self._replaced(commit):
            stored = stored.where((F.col("_batch").cast("int") >= batch) | ~one_of(self.partition_by[0], values))
        return stored.select(*commit.columns)

    def _replaced(self, commit: Row) -> list[tuple[int, list]]:
        """(batch, values it replaced), as far as the commit has the batch."""
        if len(self.partition_by) != 1:
            return []
        found = self.history().where("replaced IS NOT NULL").select(F.element_at("batches", -1).alias("b"), "replaced").collect()
        return [(r.b, list(r.replaced)) for r in found if r.b in commit.batches]

    def replaced_since(self, version: int) -> list | None:
        """Partition values that later versions replaced; None if one of them changed the table in another way."""
        later = self.history().where(F.col("version") > version).select("replaced").collect()
        if any(r.replaced is None for r in later):
            return None
        return sorted({v for r in later for v in r.replaced}, key=lambda v: (v is not None, v))

    def added_rows(self, commit: Row) -> DataFrame:
        """The rows of the batch an append or merge wrote."""
        return self.rows_of(commit, commit.batches[-1:])

    # -- writes -----------------------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> Row:
        return self._write(df, "overwrite", self.commit(), keep=False)

    def append(self, df: DataFrame, op: str = "append") -> Row:
        """Add a batch. New columns join the schema; a changed type is refused."""
        return self._write(df, op, self.commit(), keep=True)

    def replace(self, df: DataFrame, values: Sequence[str | None]) -> Row:
        """A batch that holds all rows of some partition values; only their folders are written."""
        last = self.require()
        old = self.rows_of(last).where(one_of(self.partition_by[0], values))
        return self._write(df, "replace", last, keep=True, replaced=list(values), gone=old.count())

    def restore(self, version: int) -> Row:
        """A new version made of an older version's batches; no data is rewritten."""
        old = self.require(version)
        return self._log("restore", self.require(), old.batches, old.columns, old.column_types, old.n_rows, 0)

    def _write(
        self, df: DataFrame, op: str, last: Row | None, keep: bool, replaced: list | None = None, gone: int = 0
    ) -> Row:
        known = last if keep else None
        schema = dict(zip(known.columns, known.column_types)) if known else {}
        incoming = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        changed = sorted(c for c, t in incoming.items() if schema.get(c, t) != t)
        if changed:
            raise ValueError(f"[{self.name}] type of column(s) {changed} differs from the table")
        schema |= incoming
        batch = last.next_batch if last else 0
        target = f"{self.path}/_batch={batch}"
        # no commit names this batch yet: what a writer that died before its commit left there goes
        if self.partition_by:
            spread_for(df, self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by).parquet(target)
        else:
            df.write.mode("overwrite").parquet(target)
        written = self.spark.read.schema(df.schema).parquet(target).count()  # from the file footers
        batches = [*(known.batches if known else []), batch]
        n_rows = written + (known.n_rows if known else 0) - gone
        return self._log(op, last, batches, list(schema), list(schema.values()), n_rows, written, batch + 1, replaced)

    def _log(self, op, last, batches, columns, types, n_rows, added, next_batch=None, replaced=None) -> Row:
        version = 0 if last is None else last.version + 1
        next_batch = last.next_batch if next_batch is None else next_batch
        values = (
            self.name, version, op, list(batches), list(columns), list(types), n_rows, added, next_batch, None, replaced
        )
        row = self.spark.createDataFrame([values], COMMITS).withColumn("committed_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return Row(*_COMMIT_FIELDS)(*values)


def schema_versions(history: DataFrame, major: int | str = 1) -> DataFrame:
    """Per version: the columns it added over version 0, and `major.<number of them>`."""
    first = history.where("version = 0").select("table_name", F.col("columns").alias("_first"))
    added = F.array_sort(F.array_except("columns", "_first"))
    return history.join(first, "table_name").select(
        "table_name",
        "version",
        added.alias("columns_added"),
        F.concat_ws(".", F.lit(str(major)), F.size(added).cast("string")).alias("schema_version"),
    )


def append_rows(spark: SparkSession, path: str, rows: Sequence[tuple], schema: StructType | str) -> None:
    """Append a few driver-made rows (run logs, metadata) under an explicit schema."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def read_if_exists(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at `path`, or no rows if nothing was written there yet. Any other error is the caller's."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
