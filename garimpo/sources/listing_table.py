"""A listing table that is upserted: a bucketed base, delta folders, and a manifest of what is live.

The base has one row a key, in ``buckets`` files hashed and sorted by the key, so that
a join with later versions shuffles those alone. Deltas are folders of versions, added
one by one. Each change writes a new manifest version, a folder of one row that names
the base and the deltas; the newest version is the table. A version that is there
already is never replaced: of two writers one fails, and what readers have opened stays.

``compact`` writes base and deltas as a new base and swaps the manifest. Folders of
earlier versions are left where they are.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.operators.dedup import last_by
from garimpo.session import exists

_MANIFEST = "version long, base string, buckets int, fields string, deltas array<string>"


class ListingTable:
    """The table below ``root``: newest version of each ``key`` by ``order``; of equal ones the later added."""

    def __init__(self, spark: SparkSession, root: str, order: list[str], key: str = "id"):
        self.spark, self.root, self.order, self.key = spark, root.rstrip("/"), list(order), key

    # ---- what is live

    def manifest(self) -> dict | None:
        """The newest version; None for a table that is not there yet."""
        path = f"{self.root}/manifest"
        if not exists(self.spark, path):
            return None
        row = self.spark.read.schema(_MANIFEST).parquet(f"{path}/*").orderBy(F.desc("version")).first()
        return row.asDict() if row else None

    def _publish(self, version: int, base: str, buckets: int, schema: T.StructType, deltas: list[str]) -> None:
        row = {"version": F.lit(version).cast("long"), "base": F.lit(base), "buckets": F.lit(buckets), "fields": F.lit(schema.json())}
        row["deltas"] = F.array(*(F.lit(d) for d in deltas)).cast("array<string>")
        one = self.spark.range(1, numPartitions=1).select(*(c.alias(name) for name, c in row.items()))
        one.write.parquet(f"{self.root}/manifest/{version:012d}")

    # ---- writing

    def _write_base(self, rows: DataFrame, buckets: int, counts: Observation | None = None) -> str:
        """A new base: one file a bucket, sorted by the key. ``counts`` takes the rows, and those with ``_old`` set."""
        base = f"base-{uuid.uuid4().hex}"
        spread = rows.repartition(buckets, self.key).sortWithinPartitions(self.key)
        if counts is not None:
            # Behind the last shuffle: there a task that is run again is counted once.
            old = F.count_if("_old").alias("antes")
            spread = spread.observe(counts, old, F.count("*").alias("depois")).drop("_old")
        writer = spread.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        writer.option("path", f"{self.root}/{base}").saveAsTable(self._name(base))
        return base

    def create(self, rows: DataFrame, buckets: int | None = None, single: bool = False) -> ListingTable:
        """The table with ``rows``, the newest of each key, as its base; ``single``: each key has one row."""
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        base = self._write_base(rows if single else last_by(rows, [self.key], self.order), buckets)
        self._publish(0, base, buckets, rows.schema, [])
        return self

    def add(self, rows: DataFrame, name: str | None = None, required: str | None = None) -> dict[str, int]:
        """Versions that are newer, or not; added again under the same ``name`` they replace themselves.

        Rows without the ``required`` column are not taken. The job that writes the others counts
        both: the result is the rows ``recebidos`` and ``rejeitados``.
        """
        live = self.manifest()
        schema = _schema(live)
        name = f"delta-{name or uuid.uuid4().hex}"
        counts, refused = Observation(), F.lit(False) if required is None else F.col(required).isNull()
        seen = rows.observe(counts, F.count("*").alias("recebidos"), F.count_if(refused).alias("rejeitados"))
        seen.filter(~refused).select(*schema.names).write.mode("overwrite").parquet(f"{self.root}/{name}")
        if name not in live["deltas"]:
            self._publish(live["version"] + 1, live["base"], live["buckets"], schema, [*live["deltas"], name])
        return counts.get

    def compact(self, buckets: int | None = None) -> dict[str, int] | None:
        """Base and deltas as a new base; None if there are no deltas.

        The result, counted in the job that writes the base: its rows ``antes`` and ``depois``,
        and those ``adicionados``.
        """
        live = self.manifest()
        if not live["deltas"]:
            return None
        many, counts = buckets or live["buckets"], Observation()
        base = self._write_base(self._merged(live, self.base()), many, counts)
        self._publish(live["version"] + 1, base, many, _schema(live), [])
        return counts.get | {"adicionados": counts.get["depois"] - counts.get["antes"]}

    # ---- reading

    def _name(self, base: str) -> str:
        return f"listing_{hashlib.md5(f'{self.root}/{base}'.encode()).hexdigest()}"

    def base(self) -> DataFrame:
        """The base as a bucketed table, known to the session's catalog under a name of its own."""
        live = self.manifest()
        schema = _schema(live)
        name, fields = self._name(live["base"]), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
            f"INTO {live['buckets']} BUCKETS LOCATION '{self.root}/{live['base']}'"
        )
        return self.spark.table(name)

    def rows(self) -> DataFrame:
        """The newest version of each key. The base is read once and not shuffled."""
        live, base = self.manifest(), self.base()
        return self._merged(live, base).drop("_old") if live["deltas"] else base

    def _merged(self, live: dict, base: DataFrame) -> DataFrame:
        """Base and deltas, with ``_old`` for the keys that the base has."""
        later = self.spark.read.schema(base.schema).parquet(*(f"{self.root}/{d}" for d in live["deltas"]))
        # Deltas are small and read whole; the file name tells which of equal versions came later.
        place = F.array_position(F.array(*(F.lit(d) for d in live["deltas"])), F.regexp_extract(F.col("_metadata.file_path"), r"(delta-[^/]+)/[^/]*$", 1))
        later = last_by(later.withColumn("_place", place), [self.key], [*self.order, "_place"]).drop("_place")
        sides = {"b": base, "d": later}
        b, d = (F.col(f"_{s}.{self.key}") for s in sides)
        joined = base.alias("_b").join(later.alias("_d"), b == d, "full_outer")
        newer = b.isNull() | (F.struct(*(F.col(f"_d.{c}") for c in self.order)) >= F.struct(*(F.col(f"_b.{c}") for c in self.order)))
        taken = d.isNotNull() & newer
        return joined.select(*(F.when(taken, F.col(f"_d.{c}")).otherwise(F.col(f"_b.{c}")).alias(c) for c in base.columns), b.isNotNull().alias("_old"))


def _schema(live: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(live["fields"]))
