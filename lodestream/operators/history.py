"""History of changing attributes (problem 4): every value with the period it held.

Raw changes (entity, field, value, at_ms) are the source of truth; chains of periods
derive from them. Late or corrected changes never patch a chain in place: the affected
entities' raw changes are retrieved, their chains rebuilt whole, and those chains
replaced at once (affected-chain rebuild). Chains are stored in buckets of entities; an update
reads and writes only the buckets it touches, and becomes visible as a whole or not at all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestream.functions.instants import with_utc_ms
from lodestream.functions.values import placeholder_list, present, single_spaced
from lodestream.operators.slices import SLICE_ROWS, has_hot_key, sliced
from lodestream.session import cut, shared_dir
from lodestream.sources.tables import table

#: The followed fields of a stored requirement.
FIELDS = ("job_status", "number_of_positions", "location", "work_mode", "notice_period", "yearly_budget")

#: Buckets of entities in which chains are stored.
BUCKETS = 32

_CHANGES = "map<string,struct<old:string,new:string>>"


_CHAIN = "entity string, field string, value string, valid_from_ms long, valid_to_ms long, is_first boolean"


def build_chains(raw: DataFrame, most: int = SLICE_ROWS) -> DataFrame:
    """(entity, field, value, valid_from_ms, valid_to_ms, is_first) from (entity, field, value, at_ms).

    Values must be in the form in which they are compared; null values open no period.
    Consecutive equal values are one period; valid_to_ms is 0 for the last. Of several
    values at one instant the greatest text stands. No task sorts all of an entity: entities
    of more than ``most`` rows are cut into slices of time of about that many, each is sorted
    alone, then the slices' first and last values are joined up. Repeated rows count once; null
    entities, fields and instants are left out; an empty input gives an empty result.
    """
    rows = raw.select("entity", "field", "value", "at_ms").where("entity is not null and field is not null and value is not null and at_ms is not null")
    rows = rows.groupBy("entity", "field", "at_ms").agg(F.max("value").alias("value"))
    if not has_hot_key(rows, ["entity", "field"], most):
        w = W.partitionBy("entity", "field").orderBy("at_ms")
        runs = rows.withColumn("before", F.lag("value").over(w)).where("before is null or before <> value")
        return runs.select("entity", "field", "value", F.col("at_ms").alias("valid_from_ms"), F.coalesce(F.lead("at_ms").over(w), F.lit(0)).cast("bigint").alias("valid_to_ms"), F.col("before").isNull().alias("is_first"))
    rows = sliced(rows, ["entity", "field"], F.col("at_ms"), most).withColumnRenamed("__slice", "slice")
    inside = W.partitionBy("entity", "field", "slice").orderBy("at_ms")
    # runs within a slice: rows that differ from the one before
    starts = rows.withColumn("before", F.lag("value").over(inside)).where("before is null or before <> value")
    ends = starts.groupBy("entity", "field", "slice").agg(F.max_by("value", "at_ms").alias("last"))
    across = W.partitionBy("entity", "field").orderBy("slice")
    ends = ends.withColumn("carried", F.lag("last").over(across)).drop("last")
    # the first run of a slice is none if it carries on the slice before
    starts = starts.join(ends, ["entity", "field", "slice"]).where("before is not null or carried is null or carried <> value")
    firsts = starts.groupBy("entity", "field", "slice").agg(F.min("at_ms").alias("first"))
    firsts = firsts.withColumn("next_first", F.lead("first").over(across)).drop("first")
    chains = starts.join(firsts, ["entity", "field", "slice"]).withColumn("next", F.lead("at_ms").over(inside))
    opens = F.col("before").isNull() & F.col("carried").isNull()
    return chains.select("entity", "field", "value", F.col("at_ms").alias("valid_from_ms"), F.coalesce("next", "next_first", F.lit(0)).cast("bigint").alias("valid_to_ms"), opens.alias("is_first"))


def rebuild_affected(chains: DataFrame, raw: DataFrame, late: DataFrame, most: int = SLICE_ROWS) -> DataFrame:
    """chains after ``late`` changes came in; ``raw`` holds all raw changes, late ones too.

    Only entities that occur in ``late`` are retrieved from raw and rebuilt; the others'
    chains pass through as they are. A late change that is already in raw changes nothing.
    """
    touched = late.select("entity").where("entity is not null").distinct()
    rebuilt = build_chains(raw.join(touched, "entity", "left_semi"), most)
    return chains.join(touched, "entity", "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


class Conflict(Exception):
    """Another writer published first."""


class ChainStore:
    """Chains on shared storage, in buckets of entities; numbered manifests name each bucket's folder.

    A reader sees one manifest's buckets, never a mixture: folders are written under new names
    first, then the next manifest is created. Creation fails if that number is there already, so
    of two writers who began from the same manifest one gets a Conflict and no update is lost;
    apply() then starts again. A job that dies leaves only folders that no manifest names.
    ``keep`` manifests back, folders are removed.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = BUCKETS, keep: int = 3):
        self.spark, self.folder = spark, folder or f"{shared_dir(spark)}/chains-{uuid.uuid4().hex}"
        self.buckets, self.keep = buckets, keep
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The manifests that are there, ascending."""
        at = self._path(self.folder)
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n[len("manifest-") :]) for n in names if n.startswith("manifest-"))

    def manifest(self, number: int | None = None) -> tuple[int, dict[str, str]]:
        """(number, {bucket: folder}) of a manifest, the newest if none is named; (0, {}) of an empty store."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return 0, {}
        stream = self._fs.open(self._path(f"{self.folder}/manifest-{number:08d}"))
        try:
            return number, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _CHAIN)
        return self.spark.read.schema(_CHAIN).parquet(*[f"{self.folder}/{f}" for f in folders])

    def current(self) -> DataFrame | None:
        number, folders = self.manifest()
        return self._read(sorted(folders.values())) if number else None

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(self.buckets)))

    def _write(self, chains: DataFrame) -> dict[str, str]:
        """{bucket: folder} of the chains, written below a new folder."""
        name = f"data-{uuid.uuid4().hex}"
        self._bucketed(chains).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.folder}/{name}"))]
        return {f.split("=")[1]: f"{name}/{f}" for f in found if f.startswith("bucket=")}

    def publish(self, folders: dict[str, str], after: int) -> int:
        """Make ``folders`` the current ones, as the manifest after number ``after``."""
        at = self._path(f"{self.folder}/manifest-{after + 1:08d}")
        raw = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self._fs.create(raw, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        mode = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        mode[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.NONE  # fails where the number is taken
        try:
            context.rename(raw, at, mode)
        except Exception as e:
            self._fs.delete(raw, False)
            raise Conflict(f"manifest {after + 1} is there already") from e
        self._clean(after + 1)
        return after + 1

    def _clean(self, number: int) -> None:
        """Remove manifests from ``keep`` back on, and folders that only they name."""
        old = [n for n in self.numbers() if n <= number - self.keep]
        used = {f for n in self.numbers() if n > number - self.keep for f in self.manifest(n)[1].values()}
        for n in old:
            for f in set(self.manifest(n)[1].values()) - used:
                self._fs.delete(self._path(f"{self.folder}/{f}"), True)
            self._fs.delete(self._path(f"{self.folder}/manifest-{n:08d}"), False)

    def apply(self, raw: DataFrame, late: DataFrame, tries: int = 5) -> int:
        """Rebuild the chains that ``late`` touches from ``raw`` and replace them at once. Only their
        buckets are read and written; the first call builds all."""
        for _ in range(tries):
            number, folders = self.manifest()
            if not number:
                fresh = self._write(build_chains(raw))
            else:
                touched = [str(r[0]) for r in self._bucketed(late.select("entity").where("entity is not null")).select("bucket").distinct().collect()]
                before = self._read(sorted(folders[b] for b in touched if b in folders))
                fresh = {b: f for b, f in folders.items() if b not in touched} | self._write(rebuild_affected(before, raw, late))
            try:
                return self.publish(fresh, number)
            except Conflict:
                continue
        raise Conflict(f"{tries} tries were overtaken")


def _unquoted(c):
    """A JSON text, also where it was encoded twice."""
    return F.when(F.ltrim(c).startswith('"'), F.get_json_object(F.concat(F.lit('{"x":'), c, F.lit("}")), "$.x")).otherwise(c)


def _mark_late(versions: DataFrame, slice_rows: int = 1 << 16) -> DataFrame:
    """versions with ``late``: whether one of the same job that arrived before (lower id)
    happened after. Slices of ids are sorted alone, their maxima carried on."""
    rows = versions.withColumn("slice", F.floor(F.col("id") / slice_rows))
    carried = rows.groupBy("job_id", "slice").agg(F.max("at_ms").alias("top"))
    carried = carried.withColumn("top", F.max("top").over(W.partitionBy("job_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)))
    rows = rows.join(carried, ["job_id", "slice"], "left")
    seen = F.greatest("top", F.max("at_ms").over(W.partitionBy("job_id", "slice").orderBy("id").rowsBetween(W.unboundedPreceding, -1)))
    return rows.withColumn("late", F.coalesce(F.col("at_ms") < seen, F.lit(False))).drop("slice", "top")


def requirement_changes(spark: SparkSession, folder: str) -> DataFrame:
    """(entity, field, value, at_ms, late) of all raw changes of stored requirements.

    Value null: a value that is not real. ``late``: the version arrived after one that
    happened later. Damaged JSON and unusable instants give no change.
    """
    zone = F.lit("Asia/Kolkata")
    placeholders = placeholder_list(table(spark, folder, "placeholder_values"))
    stored = table(spark, folder, "metaforge_requirements").select("job_id", "created_at", "field_change_history").where("job_id is not null")
    stored = with_utc_ms(stored, "created_ms", F.col("created_at"), zone)
    entries = stored.select("job_id", F.explode(F.from_json(_unquoted(F.col("field_change_history")), f"array<struct<changed_at:string,changes:{_CHANGES}>>")).alias("e"))
    entries = with_utc_ms(entries.select("job_id", F.col("e.changed_at").alias("at"), F.col("e.changes").alias("changes")), "at_ms", F.col("at"), zone)
    versions = table(spark, folder, "jd_versions").select(F.col("requirement_id").alias("job_id"), "id", "version_number", "payload_json", "changes_json", "created_at").where("requirement_id is not null")
    versions = with_utc_ms(versions, "at_ms", F.col("created_at"), zone)
    versions = cut(_mark_late(versions))  # read twice
    changed = entries.select("job_id", "at_ms", "changes", F.lit(False).alias("late")).unionByName(
        versions.where("version_number > 1").select("job_id", "at_ms", F.from_json(_unquoted(F.col("changes_json")), _CHANGES).alias("changes"), "late")
    )
    changed = changed.select("job_id", "at_ms", "late", F.explode("changes").alias("field", "c")).where(F.col("field").isin(*FIELDS))
    changed = present(changed.select("job_id", "field", "at_ms", "late", F.col("c.old").alias("old"), F.col("c.new").alias("new")), "at_ms")
    changed = cut(changed)  # read twice
    # first values: of version 1, where it is missing the old value of the first change
    payload = F.from_json(_unquoted(F.col("payload_json")), ", ".join(f"{f} string" for f in FIELDS))
    ones = versions.where("version_number = 1").groupBy("job_id").agg(F.min_by("payload_json", "id").alias("payload_json"), F.min("at_ms").alias("one_ms"), F.min("late").alias("late"))
    begun = stored.select("job_id", "created_ms").join(ones, "job_id", "full_outer").withColumn("p", payload)
    begun = begun.select("job_id", F.coalesce("created_ms", "one_ms").alias("at_ms"), F.coalesce("late", F.lit(False)).alias("late"), F.col("p").isNotNull().alias("has"), F.explode(F.create_map(*[x for f in FIELDS for x in (F.lit(f), F.col(f"p.{f}"))])).alias("field", "value"))
    olds = changed.groupBy("job_id", "field").agg(F.min_by("old", F.struct("at_ms", "old")).alias("old"))
    begun = begun.join(olds, ["job_id", "field"], "left").withColumn("value", F.when(F.col("has"), F.col("value")).otherwise(F.col("old")))
    both = begun.select("job_id", "field", "value", "at_ms", "late").unionByName(changed.select("job_id", "field", F.col("new").alias("value"), "at_ms", "late"))
    norm = single_spaced(F.col("value"))
    return both.select(F.col("job_id").alias("entity"), "field", F.when(~norm.isin(*placeholders), norm).alias("value"), "at_ms", "late")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """job_id, field_name, field_value, valid_from_ms, valid_to_ms of all periods of fields with two or more.

    Changes in the order of arrival make the stored chains; the versions that arrived late are
    then a correction batch: the chains they touch are rebuilt and replaced in the store.
    """
    raw = cut(requirement_changes(spark, folder))
    store = ChainStore(spark)
    store.apply(raw.where("not late"), raw)
    store.apply(raw, raw.where("late"))
    out = store.current().where("not (is_first and valid_to_ms = 0)")
    return out.select(F.col("entity").alias("job_id"), F.col("field").alias("field_name"), F.col("value").alias("field_value"), "valid_from_ms", "valid_to_ms")
