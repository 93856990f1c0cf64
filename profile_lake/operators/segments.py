"""The seen set as segments: a batch reads and writes what it needs, not the whole set.

    <path>/segments/<version>-<level>/entries/bucket=<b>/   query_id, first_seen_us
    <path>/segments/<version>-<level>/filter/               Bloom filter of the ids, in blocks
    <path>/manifest/version=<n>/                            the segments in force

Each version adds one segment with its own acceptances. When :data:`FAN_IN` segments of a
level have come together they become one of the next level, so an entry is written again
about once per level, whatever the number of batches. Segments past the TTL are dropped
unread; entries past it go when their segment is merged, and are not returned before that.

A lookup asks every segment's filter for the batch's ids and then reads only the buckets
that may hold one of them. Repeats mostly lie in the small, young segments, so the large
ones are read only where a filter errs.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profile_lake.session import delete_path, path_exists

ENTRY_SCHEMA = "query_id string, first_seen_us long"
MANIFEST_SCHEMA = (
    "name string, level int, entries long, buckets long, blocks long, last_us long, horizon_us long"
)
FAN_IN = 8
# A set known before the first version is not merged with the first small segments.
START_LEVEL = 3
# Ids per bucket; a bucket is the unit a lookup reads.
BUCKET_ENTRIES = 200_000
# A filter block has 4 KiB, the size of Spark's bitmaps; every id sets PROBES bits of one block.
BLOCK_BITS = 32768
BITS_PER_ENTRY = 12
PROBES = 4


@dataclass(frozen=True)
class Segment:
    name: str
    level: int
    entries: int
    buckets: int
    blocks: int
    #: Latest acceptance.
    last_us: int


def _power_of_two(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


def _bucket(buckets: Column) -> Column:
    return F.pmod(F.xxhash64("query_id"), buckets)


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), F.col("query_id")), blocks)


def _position(probe: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe), F.col("query_id")), F.lit(BLOCK_BITS))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0


class SeenSegments:
    """Versions of a seen set under ``path``; version n is made from version n - 1.

    A version made again replaces itself. ``kept`` versions can be read.
    """

    def __init__(self, spark: SparkSession, path: str, ttl_us: int, kept: int = 10) -> None:
        self.spark = spark
        self.path = path
        self.ttl_us = ttl_us
        self.kept = kept

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/version={version}"

    def _folder(self, name: str) -> str:
        return f"{self.path}/segments/{name}"

    def segments(self, version: int) -> tuple[list[Segment], int]:
        """Segments of a version, a few per level, and the time before which entries have expired."""
        if not path_exists(self.spark, self._manifest(version)):
            return [], 0
        rows = self.spark.read.schema(MANIFEST_SCHEMA).json(self._manifest(version)).collect()
        found = [Segment(*row[:-1]) for row in rows if row.name is not None]
        return sorted(found, key=lambda s: s.name), max((row.horizon_us for row in rows), default=0)

    def whole(self, version: int) -> DataFrame:
        """Every live entry of a version: query_id, first_seen_us."""
        found, horizon = self.segments(version)
        return self._live(self._read([f"{self._folder(s.name)}/entries" for s in found]), horizon)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        # Given as single folders, so that segments with other numbers of buckets go together.
        return self.spark.read.schema(ENTRY_SCHEMA).option("recursiveFileLookup", "true").parquet(*paths)

    @staticmethod
    def _live(entries: DataFrame, horizon_us: int) -> DataFrame:
        live = entries.where(F.col("first_seen_us") >= horizon_us)
        return live.groupBy("query_id").agg(F.max("first_seen_us").alias("first_seen_us"))

    def places(self, ids: DataFrame, found: list[Segment]) -> list[str]:
        """Buckets that may hold one of ``ids``, at most all buckets of ``found``."""
        filters = None
        for s in found:
            bits = self.spark.read.schema("block long, bits binary").parquet(f"{self._folder(s.name)}/filter")
            bits = bits.withColumn("name", F.lit(s.name))
            filters = bits if filters is None else filters.unionByName(bits)
        if filters is None:
            return []
        listed = F.array(*[F.struct(F.lit(s.name).alias("name"), F.lit(s.buckets).alias("buckets"), F.lit(s.blocks).alias("blocks")) for s in found])
        asked = ids.select("query_id", F.explode(listed).alias("s")).select("query_id", "s.*")
        asked = asked.withColumn("block", _block(F.col("blocks")))
        hit = F.lit(True)
        for probe in range(PROBES):
            hit = hit & _is_set(F.col("bits"), _position(probe))
        rows = asked.join(filters, ["name", "block"]).where(hit)
        places = rows.select("name", _bucket(F.col("buckets")).alias("bucket")).distinct().collect()
        return sorted(f"{self._folder(r.name)}/entries/bucket={r.bucket}" for r in places)

    def lookup(self, ids: DataFrame, version: int) -> DataFrame:
        """The live entries of ``ids`` (query_id, repeats allowed) as of a version."""
        found, horizon = self.segments(version)
        distinct = ids.select("query_id").where("query_id IS NOT NULL").distinct()
        entries = self._read(self.places(distinct, found))
        return self._live(entries.join(distinct, "query_id", "left_semi"), horizon)

    def begin(self, entries: DataFrame) -> None:
        """Make version -1, what the first version goes on from, of a set known before."""
        self._name_segments(self._write(self._live(entries, 0), "start", START_LEVEL), -1, 0)

    def add(self, accepted: DataFrame, version: int, now_us: int) -> None:
        """Make ``version``: the one before it, this batch's acceptances, less what has expired."""
        horizon = now_us - self.ttl_us
        before, _ = self.segments(version - 1)
        found = [s for s in before if s.last_us >= horizon]
        made = self._write(self._live(accepted, horizon), f"{version:09}-0", 0)
        found = found + made
        level = 0
        while sum(s.level == level for s in found) >= FAN_IN:
            parts = [s for s in found if s.level == level]
            merged = self._live(self._read([f"{self._folder(s.name)}/entries" for s in parts]), horizon)
            larger = self._write(merged, f"{version:09}-{level + 1}", level + 1)
            found = [s for s in found if s.level != level] + larger
            made += larger
            level += 1
        self._name_segments(found, version, horizon)
        for segment in made:
            if segment not in found:  # it was merged at once
                delete_path(self.spark, self._folder(segment.name))
        self._forget(version)

    def _name_segments(self, found: list[Segment], version: int, horizon_us: int) -> None:
        rows = [(*astuple(s), horizon_us) for s in found] or [(*[None] * 6, horizon_us)]
        manifest = self.spark.createDataFrame(rows, MANIFEST_SCHEMA)
        manifest.coalesce(1).write.mode("overwrite").json(self._manifest(version))

    def _write(self, entries: DataFrame, name: str, level: int) -> list[Segment]:
        count, last_us = entries.agg(F.count(F.lit(1)), F.max("first_seen_us")).first()
        if not count:
            return []
        segment = Segment(
            name, level, count, _power_of_two(-(-count // BUCKET_ENTRIES)),
            _power_of_two(-(-count * BITS_PER_ENTRY // BLOCK_BITS)), last_us,
        )
        bucketed = entries.withColumn("bucket", _bucket(F.lit(segment.buckets)))
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self._folder(name)}/entries")
        written = self._read([f"{self._folder(name)}/entries"])
        positions = F.array(*[_position(probe) for probe in range(PROBES)])
        bits = written.select(_block(F.lit(segment.blocks)).alias("block"), F.explode(positions).alias("position"))
        bits = bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))
        bits.write.mode("overwrite").parquet(f"{self._folder(name)}/filter")
        return [segment]

    def _forget(self, version: int) -> None:
        """Remove the version that is no longer kept, and segments only it names."""
        old = version - self.kept
        if old < 0:
            return
        gone = {s.name for s in self.segments(old)[0]}
        for number in range(old + 1, version + 1):
            gone -= {s.name for s in self.segments(number)[0]}
        for name in gone:
            delete_path(self.spark, self._folder(name))
        delete_path(self.spark, self._manifest(old))
