"""SimHash near-duplicates by pigeonhole blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, shingles three words (all words
of a shorter text), hashed by XXH64. A bit of the fingerprint is set if more than
half of the hashes have it. No words: fingerprint 0, linked like any other.

Equal fingerprints are one node. The 64 bits are cut into ``distance`` + 2 blocks;
fingerprints at most ``distance`` bits apart agree in at least two of them, so
nodes meet under every pair of blocks. Meeting pairs are verified by their
Hamming distance.

A pair of blocks shared by more than ``crowd`` nodes is not joined with itself,
since that would make pairs by the square. Its nodes are linked exactly another
way: two fingerprints are at most 2 bits apart if and only if they have a common
neighbour at most 1 bit away from each. So each crowded node is listed under its
65 neighbours, and all nodes under one neighbour get linked to the lowest of them.

Components come from alternating large-star and small-star steps over the links,
each step stored in the checkpoint folder; no links are gathered anywhere.

Null text: no words. Repeated rows: all of them get their component. An empty
table gives no rows. A null id is the smallest of its group only if it is alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import blocks
from vitrine.session import fresh_dir

WORDS, DISTANCE, SEED, CROWD = 3, 2, 42, 64


def fingerprint(text: bytes) -> int:
    """Signed 64-bit fingerprint of UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z only, white space 09-0D and 20
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    if len(words) > WORDS:
        starts, stops = starts[:-WORDS + 1], stops[WORDS - 1:]
    else:
        starts, stops = starts[:1], stops[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        votes += np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, bits`` of (doc_id, text)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(texts.bytes_of(i)) for i in range(len(texts))], pa.int64())],
                ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(make, "doc_id bigint, bits bigint")


def block_masks(distance: int) -> list[int]:
    """Masks (as signed numbers) of all pairs of blocks."""
    parts = distance + 2
    edges = [64 * i // parts for i in range(parts + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if (m := x | y) >= 1 << 63 else m for x, y in combinations(masks, 2)]


def close_links(nodes: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (a, b), a < b, that connect all ``bits`` at most ``distance`` (1 or 2) apart; ``nodes.bits`` is distinct."""
    masks = block_masks(distance)
    keyed = nodes.select("bits", F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m)) for m in masks])
                                              ).alias("block", "part"))
    sizes = keyed.groupBy("block", "part").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    met = keyed.join(sizes, ["block", "part"])
    calm = met.where(F.col("n") <= crowd)
    left = calm.select("block", "part", F.col("bits").alias("a"))
    right = calm.select("block", "part", F.col("bits").alias("b"))
    pairs = (left.join(right, ["block", "part"]).where(F.col("a") < F.col("b"))
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b"))
    # Neighbours one bit away suffice for two bits; for one bit of distance each pair is verified again.
    around = [F.col("bits"), *(F.col("bits").bitwiseXOR(F.lit(m - (1 << 64) if (m := 1 << i) >= 1 << 63 else m))
                               for i in range(64))]
    crowded = met.where(F.col("n") > crowd).select("bits").distinct()
    listed = crowded.select("bits", F.explode(F.array(*around)).alias("hub"))
    if distance == 1:
        listed = listed.join(nodes.select(F.col("bits").alias("hub")), "hub", "left_semi")
    lowest = listed.groupBy("hub").agg(F.min("bits").alias("a"), F.count("*").alias("n")).where(F.col("n") > 1)
    hubs = (listed.join(lowest.select("hub", "a"), "hub").where(F.col("a") < F.col("bits"))
            .select("a", F.col("bits").alias("b")))
    return pairs.union(hubs).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): the lowest node it is connected with.

    Large-star: every node links its larger neighbours to its lowest. Small-star:
    every node links its smaller neighbours to the lowest of them.
    """
    spark = links.sparkSession

    def stored(frame: DataFrame) -> DataFrame:
        path = fresh_dir(spark, "links")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    def star(links: DataFrame, large: bool) -> DataFrame:
        pairs = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        if large:
            pairs = pairs.union(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        else:
            pairs = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
        lowest = pairs.groupBy("node").agg(F.min("other").alias("low")).select(
            "node", F.least("node", "low").alias("low"))
        moved = pairs.join(lowest, "node")
        if large:
            new = moved.where(F.col("other") > F.col("node")).select(F.col("low").alias("a"), F.col("other").alias("b"))
        else:
            new = moved.select(F.col("low").alias("a"), F.col("other").alias("b")).union(
                lowest.select(F.col("low").alias("a"), F.col("node").alias("b")))
        return new.where(F.col("a") < F.col("b")).distinct()

    def mark(links: DataFrame):
        return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(links)
    before = mark(now)
    while True:
        now = stored(star(star(now, True), False))
        after = mark(now)
        if after == before:
            return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        before = after


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """``doc_id, bits, component_id`` for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "fingerprints")
    fingerprints(docs).write.parquet(path)
    marked = spark.read.parquet(path)
    # One node per fingerprint, named by its smallest id.
    nodes = marked.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    roots = components(close_links(nodes.select("bits"), distance, crowd))
    placed = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root"))
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_bits = placed.select("bits", "root").join(named, "root").select("bits", "component_id")
    return marked.join(by_bits, "bits").select("doc_id", "bits", "component_id")
