"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import ranked
from creditlake.settings import stage

#: Cells of the ring. Their loads are all that reaches the driver, whatever the size of the table.
CELLS = 1 << 16
VIRTUAL = 64


def _spot(name: str) -> int:
    return xxhash.xxh64_intdigest(name, 7) >> 1


class Ring:
    """Shards at `virtual` places each on a circle of 2^63; a place belongs to the next shard clockwise."""

    def __init__(self, shards: int, virtual: int = VIRTUAL):
        nodes = sorted((_spot(f"{s}/{v}"), s) for s in range(shards) for v in range(virtual))
        self.places = [p for p, _ in nodes]
        self.shards = shards
        # For each arc, all shards in the order in which they are met clockwise.
        self.routes: list[list[int]] = []
        owners = [s for _, s in nodes]
        for i in range(len(owners)):
            self.routes.append(list(dict.fromkeys(owners[i:] + owners[:i])))

    def route(self, place: int) -> list[int]:
        return self.routes[bisect.bisect_left(self.places, place) % len(self.places)]


def place_cells(loads: dict[int, int], ring: Ring) -> dict[int, int]:
    """The shard of each cell of the ring.

    A shard is full at the mean load. A cell goes to its own shard if that has room for it, else on clockwise to the
    first that has; when none has, to the emptiest. Heavy cells come first, by powers of two, then in ring order, so the
    light ones fill what is left and shards end within about one light cell of each other.
    """
    room = [-(-sum(loads.values()) // ring.shards)] * ring.shards
    placed = {}
    for cell in sorted(loads, key=lambda c: (-loads[c].bit_length(), c)):
        route = ring.route(_spot(f"cell {cell}"))
        shard = next((s for s in route if room[s] >= loads[cell]), None)
        if shard is None:
            shard = max(route, key=lambda s: room[s])  # the first met of the emptiest
        room[shard] -= loads[cell]
        placed[cell] = shard
    return placed


def shard(docs: DataFrame, shards: int = 24, cells: int = CELLS, virtual: int = VIRTUAL) -> DataFrame:
    """Shard and slot of each document: (doc_id, size, text_crc32, shard, slot).

    Documents hash into `cells` fixed cells of the ring, by id and text; cells go to shards with bounded loads, where the
    load is the bytes of the text plus 8. Only the loads of the cells, at most `cells` numbers, reach the driver, and
    the same number of pairs comes back as a broadcast table. Another shard or other documents move the cells that
    then overflow or gain a nearer shard, and no others. Slots number a shard's documents from 0 by id. Rows with equal id and
    text share a cell, hence a shard; documents with equal texts but other ids do not, since a text that a third of the rows
    hold would fill more than a shard.

    A null text has no bytes and the checksum of none; a null id hashes like any value; repeated rows share a cell and
    have slots of their own. An empty table gives an empty result, and shards may stay empty if there are few documents.
    Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    cell = F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)).cast("int")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), cell.alias("cell"))
    rows = stage(rows, "cells")
    loads = {r["cell"]: r["load"] for r in rows.groupBy("cell").agg(F.sum("size").alias("load")).collect()}
    placed = place_cells(loads, Ring(shards, virtual))
    owners = spark.createDataFrame(list(placed.items()), "owned int, shard int")
    rows = rows.join(F.broadcast(owners), F.col("cell") == F.col("owned")).drop("owned")
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return ranked(rows, ["shard"], order, "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
