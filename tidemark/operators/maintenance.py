"""Maintenance of a table's partitions: a chain of steps that a status log makes restartable.

    claimed -> decided -> staging -> staged -> audited -> verified -> publishing -> published -> done
                                       \\-> refused <-/                                   \\-> rolled_back

Each step is one job over all partitions that have come to it, and ends with rows in an append-only log. Whoever is
killed leaves a log that says how far every partition came; the next run goes on from there and does nothing twice: what was
being staged is deleted and staged anew, what was being published is looked up in the catalog.

* claim: the largest partitions without an entry, as many as asked for;
* decide: `copy` where files are large on average (they keep their number), else `rewrite` into as few as the bytes ask for;
* stage: all rewritten together beside the table, rows dealt by their place in the old files;
* audit: every column of every staged file is read; damaged ones are refused before anyone sees them;
* verify: the rows staged are counted against those the table has now, so rows that came meanwhile refuse the copy;
* publish: the catalog is pointed to the new folders, the old ones stay;
* check: the published files are audited once more, and partitions that fail are pointed back to their old folders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.paths import MERGE_THRESHOLD
from tidemark.operators.joins import latest_per_key
from tidemark.operators.upkeep import OK, COUNT_MISMATCH, materialised, point_partitions, scanned_sizes, version_folder
from tidemark.operators.workqueue import claim
from tidemark.session import delete_folder
from tidemark.sources.inventory import file_audit, file_path, rewrite_decision, with_target_files
from tidemark.sources.tables import partition_columns

WAITING, CLAIMED, DECIDED, STAGING, STAGED, AUDITED = "waiting", "claimed", "decided", "staging", "staged", "audited"
VERIFIED, PUBLISHING, PUBLISHED, DONE, REFUSED, ROLLED_BACK = "verified", "publishing", "published", "done", "refused", "rolled_back"
DAMAGED = "damaged"
ENDS = (DONE, REFUSED, ROLLED_BACK)
#: What a log row holds besides the partition: facts are carried on from row to row.
TEXT, WHOLE = StringType(), LongType()
FACTS = {"decision": TEXT, "files_before": WHOLE, "target_files": WHOLE, "files_after": WHOLE, "rows": WHOLE, "path": TEXT,
         "previous": TEXT, "detail": TEXT}
LOG = StructType([StructField(n, k) for n, k in ({"partition": TEXT, "sequence": WHOLE, "status": TEXT} | FACTS).items()])
CARRIED = list(FACTS)


class Maintenance:
    """The chain over one catalog table. `log` is the folder of the status log, one owner at a time.

    `on_step(status)` is called when a step's rows are in the log.
    """

    def __init__(self, spark: SparkSession, name: str, log: str, threshold: int = MERGE_THRESHOLD,
                 file_format: str = "parquet", on_step: Callable[[str], None] = lambda status: None):
        self.spark, self.name, self.log, self.threshold = spark, name, log, threshold
        self.file_format, self.on_step = file_format, on_step
        self.levels = partition_columns(spark, name)
        kinds = {f.name: f for f in spark.table(name).schema}
        self.spec = StructType([kinds[c] for c in self.levels])

    # --- the log ---

    def entries(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.log)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(self.log)

    def states(self, *statuses: str) -> DataFrame:
        """The last entry of every partition, or of those in one of the statuses."""
        last = latest_per_key(self.entries(), ["partition"], ["sequence"], ["sequence", "status", *CARRIED])
        return last.filter(F.col("status").isin(*statuses)) if statuses else last

    def append(self, entries: DataFrame, status: str | Column, /, **facts: Column) -> None:
        """Log rows that follow the given entries, with the facts that are new."""
        named = F.lit(status) if isinstance(status, str) else status
        new = entries.withColumns({"sequence": F.col("sequence") + 1, "status": named, **facts})
        new.select(*[F.col(f.name).cast(f.dataType) for f in LOG]).coalesce(1).write.mode("append").parquet(self.log)

    def identity(self) -> Column:
        """A partition's name in the log: its values as JSON, nulls included."""
        return F.to_json(F.struct(*self.levels), {"ignoreNullFields": "false"})

    def values(self, rows: DataFrame) -> DataFrame:
        """Log entries with the partition's values."""
        return rows.withColumn("_spec", F.from_json("partition", self.spec)).select("*", "_spec.*").drop("_spec")

    # --- the steps ---

    def sizes(self) -> DataFrame:
        found = scanned_sizes(self.spark.table(self.name), self.levels)
        return found.withColumns({"partition": self.identity(), "avg_file_bytes": F.floor(F.col("total_bytes") / F.col("files"))})

    def claim(self, limit: int | None) -> None:
        sizes = materialised(self.sizes(), "maintenance")
        picked = claim(sizes, self.entries(), "partition", "sequence", "status", "total_bytes",
                       2**31 - 1 if limit is None else limit, WAITING, CLAIMED)
        none = {c: F.lit(None) for c in CARRIED}
        picked.withColumns(none).select(*[F.col(f.name).cast(f.dataType) for f in LOG]).coalesce(1).write.mode("append").parquet(self.log)

    def decide(self) -> None:
        known = with_target_files(rewrite_decision(self.sizes(), self.threshold), self.threshold).select(
            "partition", F.col("decision").alias("_decision"), "files", F.col("target_files").alias("_target"), F.col("rows").alias("_rows"),
            F.regexp_replace(file_path("any_file"), "/[^/]*$", "").alias("_place"))
        met = self.states(CLAIMED).join(known, "partition")
        self.append(met, DECIDED, decision=F.col("_decision"), files_before=F.col("files"), rows=F.col("_rows"), previous=F.col("_place"),
                    target_files=F.when(F.col("_decision") == "copy", F.col("files")).otherwise(F.col("_target")))

    def stage(self) -> None:
        # What a killed run has begun is removed first; the folders are its own.
        for row in self.states(STAGING).select("path").distinct().toLocalIterator():
            delete_folder(self.spark, row["path"])
        folder = version_folder(self.spark, self.name)
        open_ = materialised(self.states(DECIDED, STAGING), "maintenance")
        self.append(open_, STAGING, path=F.lit(folder))
        self.on_step(STAGING)
        before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
        plan = self.values(open_.withColumn("_first", F.coalesce(F.sum("target_files").over(before), F.lit(0))))
        total = plan.agg(F.sum("target_files")).first()[0]
        if not total:
            return
        plan = materialised(plan.select(*[F.col(c).alias(f"_{c}") for c in self.levels], "_first", "target_files"), "maintenance")
        columns = self.spark.table(self.name).columns
        rows = self.spark.table(self.name).withColumn("_place", F.hash("_metadata.file_path").cast("long") + F.col("_metadata.row_index"))
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(plan[f"_{c}"]) for c in self.levels])
        dealt = rows.join(plan, same).select(
            *[rows[c] for c in columns], (F.col("_first") + F.pmod("_place", F.col("target_files"))).cast("int").alias("_no"))
        dealt.repartitionById(int(total), "_no").drop("_no").write.partitionBy(*self.levels).format(self.file_format).save(folder)
        found = scanned_sizes(self.spark.read.schema(self.spark.table(self.name).schema).format(self.file_format).load(folder), self.levels)
        found = found.select(self.identity().alias("partition"), F.col("rows").alias("_new"), "files",
                             F.regexp_replace(file_path("any_file"), "/[^/]*$", "").alias("_folder"))
        met = self.states(STAGING).join(found, "partition", "left")
        self.append(met, F.when(F.col("_folder").isNull(), REFUSED).otherwise(STAGED), rows=F.coalesce("_new", F.lit(0)), files_after=F.col("files"),
                    path=F.coalesce("_folder", "path"), detail=F.when(F.col("_folder").isNull(), COUNT_MISMATCH))

    def audited(self, rows: DataFrame) -> DataFrame:
        """Log entries with `_sound`: every file of `path` can be read and together they have the rows."""
        folders = [r["path"] for r in rows.select("path").distinct().collect()]  # a folder for each partition
        if not folders:
            return rows.withColumn("_sound", F.lit(True)).filter("false")
        found = file_audit(self.spark, folders, self.file_format).groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("path")).agg(
            F.min("readable").alias("_readable"), F.sum("rows").alias("_found"))
        sound = F.coalesce(F.col("_readable") & (F.col("_found") == F.col("rows")), F.lit(False))
        return materialised(rows.join(found, "path", "left").withColumn("_sound", sound).drop("_readable", "_found"), "maintenance")

    def audit(self) -> None:
        met = self.audited(self.states(STAGED))
        self.append(met, F.when(F.col("_sound"), AUDITED).otherwise(REFUSED), detail=F.when(~F.col("_sound"), DAMAGED))

    def verify(self) -> None:
        counts = self.spark.table(self.name).groupBy(*self.levels).agg(F.count("*").alias("_live"))
        met = self.states(AUDITED).join(counts.select(self.identity().alias("partition"), "_live"), "partition", "left")
        same = F.coalesce(F.col("_live") == F.col("rows"), F.lit(False))
        self.append(met, F.when(same, VERIFIED).otherwise(REFUSED), detail=F.when(~same, COUNT_MISMATCH))

    def publish(self) -> None:
        self.append(self.states(VERIFIED), PUBLISHING)
        self.on_step(PUBLISHING)
        # Pointing is repeated for what a killed run had begun: it comes to the same.
        self.point(self.values(self.states(PUBLISHING)), "path")
        self.append(self.states(PUBLISHING), PUBLISHED)

    def check(self) -> None:
        met = self.audited(self.states(PUBLISHED))
        self.point(self.values(met.filter(~F.col("_sound"))), "previous")
        self.append(met, F.when(F.col("_sound"), DONE).otherwise(ROLLED_BACK), detail=F.when(F.col("_sound"), OK).otherwise(DAMAGED))

    def point(self, rows: DataFrame, place: str) -> None:
        point_partitions(self.spark, self.name, ((({c: r[c] for c in self.levels}), r[place]) for r in rows.toLocalIterator()))

    def run(self, limit: int | None = None) -> DataFrame:
        """Go on with what is open, claim up to `limit` further partitions, and take all through the chain.

        Returns the last entry of every partition in the log, with the partition's values.
        """
        steps = ((CLAIMED, lambda: self.claim(limit)), (DECIDED, self.decide), (STAGED, self.stage), (AUDITED, self.audit),
                 (VERIFIED, self.verify), (PUBLISHED, self.publish), (DONE, self.check))
        for status, step in steps:
            step()
            self.on_step(status)
        return self.values(self.states())


def maintain(spark: SparkSession, name: str, log: str, limit: int | None = None, threshold: int = MERGE_THRESHOLD,
             file_format: str = "parquet") -> DataFrame:
    """Compact, audit, verify and publish a table's partitions; see `Maintenance`. The last log entry of each is returned."""
    return Maintenance(spark, name, log, threshold, file_format).run(limit)
