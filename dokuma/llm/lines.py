"""Problem 4: lines repeated across one source's documents.

Lines of each channel are nodes of a graph, weighted by the number of recordings that hold them; two lines that follow each other in a text, blank ones
aside, are an edge, weighted likewise. Nodes and edges of high support stay, and connected components are the boilerplate blocks (notices, calls, credits; a
repeated line without repeated neighbour is a block of its own). Lines below ``LONG`` words are too common to be repeated by themselves ("Evet.", "Abone ol!"): they
count only as parts of a block that has a long line, and go only where they stand in a row with one.

Support is counted from distinct (channel, line, recording) rows, so a line that fills a third of the table is
spread over its recordings; occurrences are found by ``hot_split_join``, which broadcasts the few hottest lines only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import DIGITS, channel_names, words
from ..operators.skew import hot_split_join
from ..session import materialize, spread
from .components import components


LONG = 4  # words


def split_lines(text: str) -> list[str]:
    """Lines that end at LF or CRLF."""
    return [x[:-1] if x.endswith("\r") else x for x in text.split("\n")[:-1]] + [text.split("\n")[-1]] if "\n" in text else [text]


def line_rows(clips: DataFrame, long: int = LONG) -> DataFrame:
    """One row per line with words in a text that has a channel: id, line_no, nth of the lines with words, whether it has ``long`` words, channel name, source_id and
    the 128-bit key of its words, with each run of digits read as 0. Repeated rows of a clip give repeated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, no, nth, size, keys = [], [], [], [], bytearray()
            for i, t in enumerate(b.column(3).to_pylist()):
                if t is None:
                    continue
                n = 0
                for k, line in enumerate(split_lines(t)):
                    ws = words(line)
                    if ws:
                        at.append(i)
                        no.append(k)
                        nth.append(n)
                        size.append(len(ws) >= long)
                        keys += xxhash.xxh3_128_digest(DIGITS.sub("0", " ".join(ws)))
                        n += 1
            if not at:
                continue
            k = np.frombuffer(bytes(keys), np.int64).reshape(-1, 2)
            ids, source, channel = (c.take(pa.array(at)) for c in (b.column(0), b.column(1), channel_names(b.column(2))))
            out = pa.RecordBatch.from_arrays([ids, pa.array(no, pa.int32()), pa.array(nth, pa.int32()), pa.array(size), channel, source, pa.array(k[:, 0]), pa.array(k[:, 1])], ["id", "line_no", "nth", "long", "channel", "source_id", "k1", "k2"])
            yield out.filter(pc.and_(pc.is_valid(channel), pc.is_valid(ids)))

    scan = spread(clips.select("id", F.col("source_id").cast("long").alias("source_id"), "channel", "text"))
    return scan.mapInArrow(run, "id string, line_no int, nth int, long boolean, channel string, source_id long, k1 long, k2 long")


NODE = ["channel", "k1", "k2"]


def repeated(lines: DataFrame, support: int = 5) -> tuple[DataFrame, DataFrame]:
    """(nodes, occurrences): lines held by at least ``support`` recordings of their channel with that number, and each of their places.
    Null recordings support nothing, but their lines are places too."""
    lines = lines.distinct()
    by_source = lines.groupBy(*NODE, "source_id").agg(F.count("*").alias("rows"), F.first("long").alias("long"))
    nodes = by_source.groupBy(*NODE).agg(F.count("source_id").alias("n_sources"), F.sum("rows").alias("n_rows"), F.first("long").alias("long")).filter(F.col("n_sources") >= support)
    nodes = materialize(nodes, "nodes")
    return nodes, materialize(hot_split_join(lines, nodes.drop("long", "n_sources"), NODE, "n_rows"), "occurrences")


def edges(occurrences: DataFrame, support: int = 5) -> DataFrame:
    """(node, next): repeated lines that follow each other in texts of at least ``support`` recordings, lines without words between them aside."""
    w = Window.partitionBy("id", "channel").orderBy("line_no")  # the lines of one text
    follows = occurrences.withColumn("node", _name()).withColumn("next", F.lead("node").over(w)).withColumn("next_nth", F.lead("nth").over(w)).filter("next_nth = nth + 1 AND source_id is not null")
    return follows.select("node", "next", "source_id").distinct().groupBy("node", "next").agg(F.count("*").alias("n")).filter(F.col("n") >= support).select("node", "next")


def _name():  # noqa: ANN202
    return F.concat_ws(":", F.col("channel"), F.lpad(F.hex("k1"), 16, "0"), F.lpad(F.hex("k2"), 16, "0"))


def blocks(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Each repeated line with its boilerplate block, the least node of its component: (channel, k1, k2, long, n_sources, n_rows, block). Components without a long line are none."""
    roots = components(links, "node", "next")
    found = nodes.withColumn("node", _name()).join(roots, "node", "left").select(*nodes.columns, F.coalesce("root", "node").alias("block"))
    whole = found.groupBy("block").agg(F.max("long").alias("any")).filter("any").select("block")
    return materialize(found.join(whole, "block", "left_semi").select(*nodes.columns, "block"), "blocks")


def members(occurrences: DataFrame, found: DataFrame) -> DataFrame:
    """Each place of a line of a block. Short lines are places only in a row of lines of their block that has a long one."""
    own = hot_split_join(occurrences, found.select(*NODE, "block", "n_rows"), NODE, "n_rows")
    w = Window.partitionBy("id", "channel").orderBy("line_no")
    parted = F.coalesce((F.lag("block").over(w) != F.col("block")) | (F.lag("nth").over(w) != F.col("nth") - 1), F.lit(True))
    rows = own.withColumn("row", F.sum(parted.cast("int")).over(w))
    return rows.withColumn("whole", F.max("long").over(Window.partitionBy("id", "channel", "row"))).filter("whole").drop("row", "whole")


def boilerplate(clips: DataFrame, support: int = 5) -> tuple[DataFrame, DataFrame]:
    """(blocks, places of their lines) of all texts of ``clips``."""
    nodes, occurrences = repeated(materialize(line_rows(clips), "lines"), support)
    found = blocks(nodes, edges(occurrences, support))
    return found, members(occurrences, found)


def cleaned(clips: DataFrame, occurrences: DataFrame) -> DataFrame:
    """id, text_clean, n_removed: each clip once, its repeated lines deleted; texts without any stay as they are; null texts stay null."""
    gone = occurrences.select("id", "line_no").distinct().groupBy("id").agg(F.collect_set("line_no").alias("gone"))  # bounded by the lines of one text
    lines = F.split("text", "\n")
    keep = F.expr("filter(transform(lines, (x, i) -> struct(x, i)), p -> not array_contains(gone, int(p.i)))")
    once = clips.select("id", "text").filter("id is not null").dropDuplicates(["id"])
    j = once.join(gone, "id", "left").withColumn("lines", lines)
    return j.select("id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda p: p["x"]), "\n")).alias("text_clean"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
