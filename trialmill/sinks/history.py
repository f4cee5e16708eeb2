"""Stored history in partitions by run, where all tables of a batch appear together.

A table is a folder of parquet files in ``bucket=<hash of run id>/batch=<attempt>`` partitions, the same bucket
for a run's rows in every table. Tasks write the partitions of one attempt; they count only once a commit record
names the attempt. Records are numbered without gaps and a number can be taken once (an exclusive rename), so of
two writers that overlap the second one finds out, leaves out what the first one stored, and tries the next
number. Nothing stored is changed in place: a merge writes new partitions for the buckets it touches, and its
record says that these replace the older ones.

Whether a run is stored already is first asked of Bloom filters: each commit keeps bitmaps of its run ids per
bucket. Only ids that pass are compared with stored ones, in their buckets; a batch of new runs reads no history.
What an interrupted attempt left behind is named by no record and is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmill.session import reliable_checkpoint

RUN = "pipeline_run_id"
#: Tables whose run ids decide what is new, and the tables that are stored with the run.
GROUPS = {
    "evaluation_runs": ("trials", "scorecards", "gate_results", "certifications", "observability_metrics", "security_scans"),
    "mcpchecker_results": ("mcpchecker_tasks",),
}
#: Rows of these are left out as well if the run has any there already, whether or not the run itself is stored.
GUARDED = ("security_scans",)
#: Natural key below the run; of rows of one batch that share it one is stored.
KEYS = {
    "evaluation_runs": (), "trials": ("variant", "trial_no"), "scorecards": (), "gate_results": ("gate_no",), "certifications": ("level",),
    "observability_metrics": (), "security_scans": ("scanner",), "mcpchecker_results": (), "mcpchecker_tasks": ("task_no",),
}
COMMITS, BITS = "_commits", "_run_bits"
#: Bits that Spark's bitmap functions keep in one value, and hash seeds of the filters.
SLOT_BITS, SEEDS = 32768, (11, 23)
#: Most tasks that write one bucket.
WRITERS = 8
_RECORD = "version long, batch string, batch_id string, tables map<string,array<int>>, replaced map<string,array<int>>"


class HistoryStore:
    """The nine tables below one folder. ``buckets`` and ``slots`` (filter size per bucket) belong to the folder:
    about 3000 runs a slot keep the filter useful; more only make it pass more ids on to the comparison."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, slots: int = 8):
        self.spark, self.folder, self.buckets, self.slots = spark, folder.rstrip("/"), buckets, slots
        self.before_commit: Callable[[], None] = lambda: None  # a hook for tests of overlapping writers

    # commit records

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _names(self, pattern: str) -> list[str]:
        """Paths below the folder that match."""
        path = self._path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [s.getPath().toString() for s in found or ()]

    def version(self) -> int:
        """Number of the newest commit; 0 before the first."""
        return max((int(n[-17:-5]) for n in self._names(f"{COMMITS}/[0-9]*.json")), default=0)

    def commits(self) -> DataFrame:
        """version, batch (the attempt), batch_id, tables and replaced (table to buckets) of every commit."""
        if not self.version():
            return self.spark.createDataFrame([], _RECORD)
        return self.spark.read.schema(_RECORD).json(f"{self.folder}/{COMMITS}/[0-9]*.json")

    def _commit(self, version: int, record: dict) -> bool:
        """Takes a number for the record; false if another writer has it."""
        new = self._path(f"{COMMITS}/new-{uuid.uuid4().hex}")
        conf = self.spark._jsc.hadoopConfiguration()
        system = new.getFileSystem(conf)
        system.mkdirs(new.getParent())
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(new).toUri(), conf)
        out = system.create(new)
        out.write(bytearray(json.dumps(record | {"version": version}).encode()))
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # fails where the name is taken
        try:
            context.rename(new, self._path(f"{COMMITS}/{version:012d}.json"), plain)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            context.delete(new, False)
            return False
        return True

    # reading

    def bucket_of(self, run: Column) -> Column:
        return F.pmod(F.xxhash64(run), F.lit(self.buckets)).cast("int")

    def visible(self, table: str) -> DataFrame:
        """(bucket, batch, version) of the partitions that count: those since the last commit that replaced the bucket."""
        rows = self.commits().select("version", "batch", F.explode(F.col("tables")[table]).alias("bucket"), F.col("replaced")[table].alias("r"))
        rows = rows.withColumn("r", F.when(F.array_contains(F.coalesce("r", F.array().cast("array<int>")), F.col("bucket")), F.col("version")))
        since = rows.groupBy("bucket").agg(F.coalesce(F.max("r"), F.lit(0)).alias("since"))
        return rows.join(since, "bucket").where("version >= since").select("bucket", "batch", "version")

    def read(self, table: str, runs: Iterable[str] | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The stored rows, or None before the first write; of ``runs`` or ``buckets`` only their partitions are listed."""
        wanted = None if buckets is None else sorted(buckets)
        if runs is not None:
            runs = list(runs)
            ids = self.spark.createDataFrame([(r,) for r in runs], f"{RUN} string")
            wanted = sorted(r[0] for r in ids.select(self.bucket_of(F.col(RUN))).distinct().collect())
        rows = self._partitions(table, wanted)
        if rows is None:
            return None
        rows = rows.join(self.visible(table).drop("version"), ["bucket", "batch"], "left_semi").drop("bucket", "batch")
        return rows if runs is None else rows.where(F.col(RUN).isin(runs))

    def _partitions(self, table: str, buckets: list[int] | None) -> DataFrame | None:
        try:
            rows = self.spark.read.parquet(f"{self.folder}/{table}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    # what is stored already

    def _bits(self, runs: DataFrame) -> DataFrame:
        """table, run id, bucket and the places of its bits in the bucket's filter."""
        wide = SLOT_BITS * self.slots
        seeds = F.explode(F.array(*map(F.lit, SEEDS)))
        rows = runs.select("table", RUN, "bucket", seeds.alias("_seed")).withColumn("_bit", F.pmod(F.xxhash64("_seed", "table", RUN), F.lit(wide)))
        return rows.select("table", RUN, "bucket", (F.col("_bit") / SLOT_BITS).cast("int").alias("slot"), (F.col("_bit") % SLOT_BITS).alias("_at"))

    def _bitmaps(self, runs: DataFrame) -> DataFrame:
        return self._bits(runs).groupBy("table", "bucket", "slot").agg(F.bitmap_construct_agg("_at").alias("bits"))

    def perhaps_stored(self, runs: DataFrame, buckets: list[int]) -> DataFrame:
        """Those of the runs (table, run id, bucket) that pass the filters; every stored one does."""
        kept = self._partitions(BITS, buckets)
        if kept is None:
            return runs.limit(0)
        kept = kept.join(self.visible(BITS).drop("version"), ["bucket", "batch"], "left_semi")
        kept = kept.groupBy("table", "bucket", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = F.conv(F.hex(F.substring("bits", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        hit = self._bits(runs).join(kept, ["table", "bucket", "slot"]).where(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1)
        return hit.groupBy("table", RUN, "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(SEEDS)).drop("n")

    def _stored(self, runs: DataFrame, buckets: list[int], since: int = 0) -> DataFrame | None:
        """(table, run id) of the runs that commits after ``since`` hold; None if there is none."""
        if since:  # what has just been stored is compared as it is
            maybe, newer = runs, [r.batch for r in self.commits().where(F.col("version") > since).select("batch").collect()]
        else:
            maybe, newer = reliable_checkpoint(self.perhaps_stored(runs, buckets)), None
        if maybe.isEmpty():
            return None
        found = []
        for table in (*GROUPS, *GUARDED):
            rows = self._partitions(table, buckets)
            if rows is not None:
                rows = rows.where(F.col("batch").isin(newer)) if newer is not None else rows
                rows = rows.join(self.visible(table).drop("version"), ["bucket", "batch"], "left_semi").select(F.lit(table).alias("table"), RUN)
                found.append(rows.join(maybe.where(F.col("table") == table).select("table", RUN), ["table", RUN], "left_semi"))
        return reliable_checkpoint(reduce(DataFrame.unionByName, found).distinct()) if found else None

    # writing

    def _stage(self, rows: Mapping[str, DataFrame], fresh: DataFrame, whole: bool) -> tuple[str, dict[str, list[int]]]:
        """Writes what is new of each table as partitions of one attempt; (attempt, buckets per table).

        ``whole``: nothing has been stored before, so a table that decides by itself keeps all its runs. Rows are dealt
        by run first: duplicates, and the join with the new runs, then need one ordering of them.
        """
        batch = f"b-{uuid.uuid4().hex}"
        gates = {child: gate for gate, children in GROUPS.items() for child in children}
        staged = {}
        for table, df in rows.items():
            new = df.where(F.col(RUN).isNotNull()).repartition(RUN).dropDuplicates([RUN, *KEYS[table]])
            for gate in dict.fromkeys(g for g in (gates.get(table), table) if g in rows and (g in GROUPS or g in GUARDED)):
                if whole and gate == table:
                    continue
                new = new.join(fresh.where(F.col("table") == gate).select(RUN), RUN, "left_semi")
            staged[table] = new
        staged[BITS] = self._bitmaps(fresh)
        return batch, {table: b for table, df in staged.items() if (b := self._write(table, df, batch))}

    def _write(self, table: str, rows: DataFrame, batch: str) -> list[int]:
        if "bucket" not in rows.columns:
            rows = rows.withColumn("bucket", self.bucket_of(F.col(RUN)))
        path = f"{self.folder}/{table}"
        spread = [F.col(c) for c in (RUN, *KEYS.get(table, ()), "slot") if c in rows.columns]
        # another hash than the bucket's, whose remainders would fall together with it
        rows = rows.withColumn("batch", F.lit(batch)).repartition("bucket", F.pmod(F.xxhash64(F.lit(1), *spread), F.lit(WRITERS)))
        rows.write.mode("append").partitionBy("bucket", "batch").parquet(f"{self.folder}/{table}")
        return sorted(int(n.split("bucket=")[-1].split("/")[0]) for n in self._names(f"{table}/bucket=*/batch={batch}"))

    def store(self, rows: Mapping[str, DataFrame], batch_id: str | None = None) -> int:
        """Stores the new runs of a batch with all their rows; the number of the commit, or of the one that had it.

        ``rows`` are tables by name, each with ``pipeline_run_id``. A run that is stored already is skipped with all
        its rows. Scans are skipped by themselves where the run has any, and may come without runs. A batch whose
        id was committed before is left out whole. Rows without a run id are not stored.
        """
        unknown = set(rows) - set(KEYS)
        if unknown:
            raise ValueError(f"no table named {sorted(unknown)}")
        base = self.version()
        if batch_id is not None and (done := self._committed(batch_id)):
            return done
        asked = [df.where(F.col(RUN).isNotNull()).select(F.lit(t).alias("table"), RUN) for t, df in rows.items() if t in GROUPS or t in GUARDED]
        fresh = reduce(DataFrame.unionByName, asked).distinct().withColumn("bucket", self.bucket_of(F.col(RUN)))
        fresh = reliable_checkpoint(fresh)
        buckets = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        known = self._stored(fresh, buckets) if base else None
        while True:
            if known is not None:
                fresh = reliable_checkpoint(fresh.join(known, ["table", RUN], "left_anti"))
            if fresh.isEmpty() and batch_id is None:
                return base
            batch, written = self._stage(rows, fresh, known is None)
            self.before_commit()
            record = {"batch": batch, "batch_id": batch_id, "tables": written, "replaced": {}}
            while not self._commit(base + 1, record):
                if batch_id is not None and (done := self._committed(batch_id)):
                    return done
                newest = self.version()
                known = self._stored(fresh, buckets, since=base)
                base = newest
                if known is not None and not known.isEmpty():
                    break  # some of it has been stored meanwhile: stage the rest anew
            else:
                return base + 1

    def _committed(self, batch_id: str) -> int | None:
        return self.commits().where(F.col("batch_id") == batch_id).agg(F.max("version")).first()[0]

    def merge(self, table: str, incoming: DataFrame, combined: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replaces the buckets that ``incoming`` touches by ``combined(stored rows there, incoming)``; other buckets stay."""
        incoming = reliable_checkpoint(incoming.where(F.col(RUN).isNotNull()))
        buckets = sorted(r[0] for r in incoming.select(self.bucket_of(F.col(RUN))).distinct().collect())
        while True:
            base = self.version()
            if not buckets:
                return base
            stored = self.read(table, buckets=buckets)
            rows = combined(incoming.limit(0) if stored is None else stored, incoming)
            batch = f"b-{uuid.uuid4().hex}"
            tables = {table: self._write(table, rows, batch)}
            if table in GROUPS or table in GUARDED:
                runs = incoming.select(F.lit(table).alias("table"), RUN, self.bucket_of(F.col(RUN)).alias("bucket")).distinct()
                tables[BITS] = self._write(BITS, self._bitmaps(runs), batch)
            self.before_commit()
            record = {"batch": batch, "batch_id": None, "tables": tables, "replaced": {table: buckets}}
            while not self._commit(base + 1, record):
                newest = self.version()
                newer = self.commits().where(F.col("version") > base).select(F.col("tables")[table].alias("b"))
                touched = newer.where(F.arrays_overlap("b", F.array(*map(F.lit, buckets))))
                base = newest
                if not touched.isEmpty():
                    break  # the buckets have changed: combine again
            else:
                return base + 1

    def compact(self, table: str) -> int:
        """Rewrites each bucket that several commits wrote as one partition."""
        many = self.visible(table).groupBy("bucket").count().where("count > 1").select("bucket").collect()
        rows = self.read(table, buckets=[r.bucket for r in many]) if many else None
        return self.version() if rows is None else self.merge(table, rows, lambda _, again: again)


def upserted(key: tuple[str, ...], kept: tuple[str, ...]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """How :meth:`HistoryStore.merge` replaces rows: those of the largest ``seq`` win, the ``kept`` columns are of the smallest.

    ``first_seq`` remembers the smallest, so that rows may come in any order. Columns that only one side has are null
    on the other. One aggregation with partial combine.
    """

    def combined(stored: DataFrame, incoming: DataFrame) -> DataFrame:
        both = stored.unionByName(incoming, allowMissingColumns=True)
        since = F.col("first_seq") if "first_seq" in both.columns else F.lit(None)
        both = both.withColumn("first_seq", F.coalesce(since, F.col("seq")))
        first = [c for c in both.columns if c in kept]
        last = [c for c in both.columns if c not in (*key, *kept, "first_seq")]
        rows = both.groupBy(*key).agg(
            F.max_by(F.struct(*last), "seq").alias("_last"), F.min_by(F.struct(*first, "seq"), "first_seq").alias("_first"), F.min("first_seq").alias("first_seq")
        )
        return rows.select(*[F.col(f"_last.{c}") if c in last else F.col(f"_first.{c}") if c in first else F.col(c) for c in both.columns])

    return combined


#: Scan rows are replaced by run and scanner; who scanned, how and when first stays.
merge_scans = upserted((RUN, "scanner"), ("scan_mode", "created_at", "submission_name"))
