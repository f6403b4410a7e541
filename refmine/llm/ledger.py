"""Records that differ only in dress, counted in a ledger that grows batch by batch.

A record's canonical key drops white space, case, punctuation and item order. The ledger
is a table bucketed by the key's digest: (scope, key, copies, first_id), in a folder of its
own. A new batch is reduced to its distinct keys and written in the same buckets;
full-outer-joined with the matching buckets of the ledger, counts are added and the
earliest representative stays. Buckets that a batch doesn't touch are neither read nor
written.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from refmine import storage
from refmine.functions.text import bare_form
from refmine.operators.skew import HOT_PARTS, hot_key_join
from refmine.session import materialize, shared_dir

#: The bucket in the name of a bucketed file.
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")
_KEYS = ("scope", "key")


def canonical_text(c: Column | str) -> Column:
    """Canonical form of one text, null for null and for texts without letters and digits."""
    form = bare_form(c)
    return F.when(form != "", form)


def canonical_items(c: Column | str) -> Column:
    """Canonical form of a list: the set of its items' forms, null if none is left."""
    c = F.col(c) if isinstance(c, str) else c
    forms = F.array_sort(F.array_distinct(F.filter(F.transform(c, bare_form), lambda x: x != "")))
    return F.when(F.size(forms) > 0, F.array_join(forms, "\u001f"))


def key_digest(*parts: Column) -> Column:
    """16-byte digest of several parts; null if any is null. The parts are joined unambiguously."""
    whole = F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.unhex(F.md5(whole))


class CopyLedger:
    """Canonical keys with their number of copies and earliest representative, in a folder.

    The folder holds one bucketed file a bucket and manifests (which files make up a version,
    which batches are in it). A version counts when its manifest is there, which one writer
    alone can create; an update that fails before leaves the version before as it was, and a
    batch that has been counted is not counted again. The folder alone is the ledger: opened
    by its path, in any session, it goes on where it was. Files of a version are removed two
    versions later, so that what was planned on the version before can still run.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """``path``: an earlier or a new ledger (none: a new one in the shared folder). ``buckets`` of a
        new one: as many as the session's shuffle partitions, unless given."""
        self.spark = spark
        self.path = (path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}").rstrip("/")
        found = self._latest()
        self.buckets = found["buckets"] if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "ledger_" + hashlib.md5(self.path.encode()).hexdigest()
        self._staged: list[str] = []
        if found:
            self._register(found)

    # Versions -------------------------------------------------------------------------

    def _latest(self) -> dict | None:
        versions = storage.file_names(self.spark, f"{self.path}/manifests")
        return json.loads(storage.read_text(self.spark, f"{self.path}/manifests/{versions[-1]}")) if versions else None

    def _register(self, manifest: dict) -> None:
        """The folder's files as a bucketed table of this session's catalog, so that scans know the buckets."""
        self._define(self.name, f"{self.path}/data", manifest["id_type"])

    def _define(self, name: str, folder: str, id_type: str) -> None:
        columns = f"scope STRING, key BINARY, copies BIGINT, first_id {id_type}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (scope, key) SORTED BY (scope, key) INTO {self.buckets} BUCKETS LOCATION '{folder}'")

    def _rows(self, files: list[str]) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col("_metadata.file_name").isin(files))

    @property
    def version(self) -> int:
        found = self._latest()
        return found["version"] if found else 0

    @property
    def entries(self) -> DataFrame | None:
        """(scope, key, copies, first_id), or None before the first update."""
        found = self._latest()
        return self._rows(list(found["files"].values())) if found else None

    # Updates --------------------------------------------------------------------------

    def update(self, batch: DataFrame, batch_id: str | None = None) -> bool:
        """Add a batch of (scope, key, id): one row a record. Null scopes and keys are left out; a batch may be empty; other columns aren't read.

        A hot key is one row a task after partial aggregation. Ids repeat as often as they
        come. A ``batch_id`` that was counted before changes nothing: False. Only the batch's
        distinct keys are shuffled, never the ledger.
        """
        found = self._latest()
        if found and batch_id is not None and batch_id in found["batches"]:
            return False
        batch_id = batch_id or uuid.uuid4().hex
        id_type = dict(batch.dtypes)["id"]
        found = found or {"version": 0, "buckets": self.buckets, "id_type": id_type, "rows": 0, "files": {}, "batches": [], "stale": []}
        folder = f"{self.path}/staged/{uuid.uuid4().hex}"
        try:
            rows = self._stage(batch, f"{folder}/batch")
            fresh = self._by_bucket(f"{folder}/batch")
            met = [b for b in fresh if b in found["files"]]
            moved = {b: f"{folder}/batch/{fresh[b]}" for b in fresh}
            storage.make_folder(self.spark, f"{self.path}/data")
            if met:
                self._register(found)
                own = self._bucketed(f"{folder}/batch", id_type).where(F.col("_metadata.file_name").isin([fresh[b] for b in met]))
                self._put(self._merged(self._rows([found["files"][b] for b in met]), own), f"{folder}/merged")
                moved |= {b: f"{folder}/merged/{n}" for b, n in self._by_bucket(f"{folder}/merged").items()}
            # Buckets that the ledger hasn't yet are taken over as they are.
            for path in moved.values():
                storage.rename(self.spark, path, f"{self.path}/data/{path.rsplit('/', 1)[1]}")
            self._commit(found, {b: path.rsplit("/", 1)[1] for b, path in moved.items()}, batch_id, rows)
            self._register(found)
        finally:
            for name in self._staged:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._staged.clear()
            storage.delete(self.spark, folder)
        return True

    def _stage(self, batch: DataFrame, folder: str) -> int:
        """Write the batch's distinct keys in the ledger's buckets; the number of its records."""
        new = batch.where("scope IS NOT NULL AND key IS NOT NULL").groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            new = new.repartition(self.buckets, *_KEYS)  # one file a bucket
        told = Observation()
        self._put(new.observe(told, F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")), folder)
        return told.get["rows"]

    def _put(self, df: DataFrame, folder: str) -> None:
        name = f"{self.name}_{uuid.uuid4().hex}"
        self._staged.append(name)
        df.write.option("path", folder).bucketBy(self.buckets, *_KEYS).sortBy(*_KEYS).saveAsTable(name)

    def _bucketed(self, folder: str, id_type: str) -> DataFrame:
        name = f"{self.name}_{uuid.uuid4().hex}"
        self._staged.append(name)
        self._define(name, folder, id_type)
        return self.spark.table(name)

    @staticmethod
    def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
        o, n = old.alias("o"), new.alias("n")
        return o.join(n, (F.col("o.scope") == F.col("n.scope")) & (F.col("o.key") == F.col("n.key")), "full_outer").select(
            F.coalesce("o.scope", "n.scope").alias("scope"),
            F.coalesce("o.key", "n.key").alias("key"),
            (F.coalesce("o.copies", F.lit(0)) + F.coalesce("n.copies", F.lit(0))).alias("copies"),
            F.least("o.first_id", "n.first_id").alias("first_id"),
        )

    def _by_bucket(self, folder: str) -> dict[str, str]:
        return {_BUCKET.search(n)[1]: n for n in storage.file_names(self.spark, folder) if _BUCKET.search(n)}

    def _commit(self, found: dict, new: dict[str, str], batch_id: str, rows: int) -> None:
        stale = [found["files"][b] for b in new if b in found["files"]]
        version = found["version"] + 1
        manifest = {**found, "version": version, "rows": found["rows"] + rows, "files": {**found["files"], **new}, "batches": [*found["batches"], batch_id], "stale": stale}
        storage.write_new(self.spark, f"{self.path}/manifests/{version:09d}.json", json.dumps(manifest))
        for n in found["stale"]:
            storage.delete(self.spark, f"{self.path}/data/{n}")
        storage.delete(self.spark, f"{self.path}/manifests/{version - 2:09d}.json")

    def vacuum(self) -> None:
        """Remove what failed updates left behind. Not while another one runs."""
        found = self._latest()
        kept = {*found["files"].values(), *found["stale"]} if found else set()
        for n in storage.file_names(self.spark, f"{self.path}/data"):
            if n not in kept:
                storage.delete(self.spark, f"{self.path}/data/{n}")
        storage.delete(self.spark, f"{self.path}/staged")

    # Copies ---------------------------------------------------------------------------

    def copies(self, rows: DataFrame) -> DataFrame:
        """(scope, first_id, copy_id) for the rows (scope, key, id) that aren't their key's representative.

        The ledger itself tells which keys are hot; their rows are matched where they lie.
        """
        manifest = self._latest()
        if manifest is None:
            raise ValueError("the ledger is empty")
        repeated = materialize(self._rows(list(manifest["files"].values())).where("copies > 1"), "repeated-keys")
        hot = repeated.where(F.col("copies") > manifest["rows"] // HOT_PARTS).select(*_KEYS)
        found = hot_key_join(rows.where("key IS NOT NULL"), repeated.drop("copies"), list(_KEYS), hot=hot)
        return found.where("id <> first_id").select("scope", "first_id", F.col("id").alias("copy_id"))


def batch_numbers(rows: DataFrame, at: str, batches: int) -> Column:
    """The run of about equal size, by the time ``at``, that a row falls in: 0 .. batches - 1; rows without a time come first.

    The bounds are approximate quantiles over all rows; every row is in exactly one batch.
    """
    seconds = F.col(at).cast("timestamp").cast("long")
    wanted = [(i + 1) / batches for i in range(batches - 1)]
    bounds = rows.select(F.percentile_approx(seconds, wanted, 1000).alias("b")).first()["b"] if wanted else []
    number = F.lit(0)
    for b in bounds or []:
        number = number + F.coalesce(F.when(seconds > b, 1), F.lit(0))
    return number
