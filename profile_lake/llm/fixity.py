"""Merkle fixity audit of web archive replicas.

Pages become WARC records in a fixed order, each with its index, offset and digest. A record's
place in the tree does not depend on the replica: it is page_id and, among records of one
page_id, the number in the order of their digests. A node covers an ordered offset range: up
to 16 places of one page_id, or up to 16 values of page_id, level by level. Its digest is
that of its children's places, offsets from the node's start, and digests, in order. So a
record that one replica lacks moves the offsets of later records, but changes no node
outside its own branch. Two replicas are compared from the top: only children of nodes that
differ are looked at, down to the records.

Null url or html: empty. Null page_id: sorts first, a branch of its own. Repeated rows are
records of their own; among records of one page_id a lost one moves the later ones up, as
nothing else tells them apart. What one replica lacks counts as differing, with null offsets
and digest. Empty table: no nodes; beside another replica all of that one differs. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profile_lake.session import stage

FAN_OUT_BITS = 4


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A response record as text: header lines, an empty line, the page, two line ends."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def manifest(pages: DataFrame) -> DataFrame:
    """Every page's record: record_index, record_offset, record_length, digest, page_id, place.

    Pages are hashed where they are scanned; digests and lengths alone are sorted, by ranges
    of (page_id, digest). Partition totals, a row per partition, carry the running index and
    offset over. ``place`` counts the records of one page_id.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    made = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha2(record, 256).alias("digest"),
        F.octet_length(record).cast("long").alias("record_length"),
    )
    ordered = made.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest")
    part = F.spark_partition_id()
    placed = ordered.withColumn("part", part).withColumn(
        "place", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    )
    placed = stage(placed, "records")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("record_length").alias("size"))
    totals = totals.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"),
    )
    own = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    within = F.coalesce(F.sum("record_length").over(own), F.lit(0))
    numbered = placed.withColumn("within", within).join(totals, "part").select(
        (F.col("first") + F.col("place")).alias("record_index"),
        (F.col("begin") + F.col("within")).alias("record_offset"),
        "record_length",
        "digest",
        "page_id",
    )
    numbered = stage(numbered, "numbered")
    firsts = numbered.groupBy(F.col("page_id").alias("same_id")).agg(F.min("record_index").alias("first"))
    return numbered.join(firsts, numbered["page_id"].eqNullSafe(firsts["same_id"])).select(
        *numbered.columns, (F.col("record_index") - F.col("first")).alias("place")
    )


def depths(*manifests: DataFrame) -> tuple[int, int]:
    """Levels that join places, then levels that join values of page_id, for trees that are compared."""
    places = pages = 0
    for records in manifests:
        last, low, high = records.agg(F.max("place"), F.min("page_id"), F.max("page_id")).first()
        places = max(places, _levels(0, last or 0))
        pages = max(pages, _levels(low or 0, high or 0))
    return places, pages


def _levels(low: int, high: int) -> int:
    """How often two numbers lose four bits until they are equal; one below zero never equals one above."""
    levels = 0
    while low != high and levels < 64 // FAN_OUT_BITS:
        low, high, levels = low >> FAN_OUT_BITS, high >> FAN_OUT_BITS, levels + 1
    return levels


def _parent(level: int, places: int) -> list[Column]:
    """Page and place of the node of ``level`` above a node of the level below."""
    if level <= places:
        return [F.col("page"), F.shiftright("place", FAN_OUT_BITS).alias("place")]
    return [F.shiftright("page", FAN_OUT_BITS).alias("page"), F.col("place")]


def tree(records: DataFrame, depth: tuple[int, int] | None = None) -> list[DataFrame]:
    """Levels from the records to the top: page, place, start, end, digest.

    Records: a manifest. ``depth``: what :func:`depths` gives for all replicas to be compared.
    A node gathers at most 16 children, whatever the number of records.
    """
    places, pages = depth or depths(records)
    level = records.select(
        F.col("page_id").alias("page"),
        "place",
        F.col("record_offset").alias("start"),
        (F.col("record_offset") + F.col("record_length")).alias("end"),
        "digest",
    )
    levels = [stage(level, "fixity-0")]
    for number in range(1, places + pages + 1):
        children = F.array_sort(F.collect_list(F.struct("child.page", "child.place", "child.start", "child.end", "child.digest")))
        up = levels[-1].select(*_parent(number, places), F.struct("*").alias("child"))
        nodes = up.groupBy("page", "place").agg(
            F.min("child.start").alias("start"), F.max("child.end").alias("end"), children.alias("children")
        )
        lines = F.transform(
            "children",
            lambda c: F.concat_ws(":", c["page"], c["place"], c["start"] - F.col("start"), c["end"] - F.col("start"), c["digest"]),
        )
        nodes = nodes.select("page", "place", "start", "end", F.sha2(F.array_join(lines, ","), 256).alias("digest"))
        levels.append(stage(nodes, f"fixity-{number}"))
    return levels


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """What differs between the manifests of two replicas, see :func:`audit`."""
    depth = depths(left, right)
    return audit(tree(left, depth), tree(right, depth), depth)


def audit(left: list[DataFrame], right: list[DataFrame], depth: tuple[int, int]) -> DataFrame:
    """Nodes that differ at every level: level, page, place, start, end, digest, found_start, found_end, found_digest.

    Level 0 are the records. Only children of differing nodes are compared.
    """
    found, suspects = [], None
    for number in range(len(left) - 1, -1, -1):
        one, two = left[number], right[number]
        if suspects is not None:
            above = suspects.select(F.col("page").alias("above_page"), F.col("place").alias("above_place"))
            page, place = _parent(number + 1, depth[0])
            match = page.eqNullSafe(F.col("above_page")) & (place == F.col("above_place"))
            one, two = (x.join(above, match, "left_semi") for x in (one, two))
        two = two.select(*[F.col(c).alias(f"found_{c}") for c in ("page", "place", "start", "end", "digest")])
        same = F.col("page").eqNullSafe(F.col("found_page")) & (F.col("place") == F.col("found_place"))
        differ = one.join(two, same, "full").filter(~F.col("digest").eqNullSafe(F.col("found_digest")))
        differ = differ.select(
            F.lit(number).alias("level"),
            F.coalesce("page", "found_page").alias("page"),
            F.coalesce("place", "found_place").alias("place"),
            "start",
            "end",
            "digest",
            "found_start",
            "found_end",
            "found_digest",
        )
        suspects = stage(differ, "differing")
        found.append(suspects)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
