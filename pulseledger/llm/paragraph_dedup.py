"""Repeated passages across documents: MinHash banding, exact Jaccard, components.

Texts are compared in units of some 17 words. Lines of ``LINE_WORDS`` words or
more are blocks of their own, shorter ones in a row are one block. A block is cut
before every word whose two-word hash is the smallest of ``REACH`` words around
it, so a passage is cut in the same places wherever it stands and however it is
wrapped: 19 in 20 of 50 words hold a whole unit, nearly all of 60 do. Units with
equal sets of five-word shingles are one class, told by 64 bits; classes that collide in a band of
MinHashes are compared exactly, and connected classes form a cluster. The
cluster's first unit (by document id and place) stays, the others go.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pulseledger.llm.common import (
    FILTER_BITS,
    connected_components,
    hash_place,
    in_filter,
    map_slices,
    membership_filter,
    mixed,
    parity_sketches,
    shared_buckets,
    shingle_hashes,
    signed,
    sketch_fact,
    sketches_allow,
    verified_links,
    word_hashes,
)
from pulseledger.session import materialise, scratch

LINE_WORDS = 20
# Cuts lie further apart than this, and from a block's ends; units are on average twice as long.
REACH = 8
# A unit without a cut for so many words (one phrase over and over) is cut anyway.
UNIT_WORDS = 64
# Tells rows apart that share an id, or have none.
_ROW = "__row"
# Two units meet in a band with probability 0.963 at the threshold of 0.75, 0.991 at 5/6; equal ones always.
BANDS, BAND_ROWS = 4, 2
# Bits of the sketch that bounds how much two units differ before they are fetched.
SKETCH_BITS = 64

_FACTORS = mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_SALTS = mixed(np.arange(1001, 1001 + BANDS, dtype=np.uint64))


class Units(NamedTuple):
    """Units of several texts: text number, number within it, span in code points, words; hashed shingles."""

    text: np.ndarray
    number: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    n_words: np.ndarray
    # Distinct shingles in order of their units, the unit of each, and where each unit's begin.
    shingles: np.ndarray
    owner: np.ndarray
    at: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.at, len(self.shingles)))

    def digests(self) -> np.ndarray:
        return signed(mixed(np.add.reduceat(mixed(self.shingles + np.uint64(1)), self.at)))

    def sketches(self) -> np.ndarray:
        return parity_sketches(self.owner, self.shingles, len(self.at), SKETCH_BITS).reshape(-1)

    def bands(self) -> np.ndarray:
        """A row of band hashes per unit."""
        total = np.zeros((len(self.at), BANDS), dtype=np.uint64)
        for n, factor in enumerate(_FACTORS):
            smallest = np.minimum.reduceat(self.shingles * factor, self.at)
            band = n // BAND_ROWS
            total[:, band] = mixed(total[:, band] ^ smallest)
        return signed(total ^ _BAND_SALTS)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, dtype=np.int64)


def _blocks(owner: np.ndarray, line: np.ndarray, line_words: int) -> np.ndarray:
    """The number of each word's block."""
    begins = _runs(line)
    long = np.diff(np.append(begins, len(line))) >= line_words
    text = owner[begins]
    new = np.ones(len(begins), dtype=bool)
    new[1:] = long[1:] | long[:-1] | (text[1:] != text[:-1])
    return np.repeat(np.cumsum(new) - 1, np.diff(np.append(begins, len(line))))


def _cuts(block: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the words before which a unit begins."""
    count = len(hashes)
    begins = _runs(block)
    length = np.diff(np.append(begins, count))
    place = np.arange(count) - np.repeat(begins, length)
    inner = (place > REACH) & (place + REACH < np.repeat(length, length))
    pair = hashes.copy()
    pair[:-1] = mixed(hashes[:-1] * np.uint64(3) ^ hashes[1:])
    lowest = inner
    for step in range(1, REACH + 1):
        # Words within reach of an inner one are in its block.
        before, after = np.roll(pair, step), np.roll(pair, -step)
        lowest = lowest & (pair < before) & ((pair <= after) | (place + step + 1 == np.repeat(length, length)))
    begin = lowest | (place == 0)
    units = np.flatnonzero(begin)
    since = np.arange(count) - np.repeat(units, np.diff(np.append(units, count)))
    return np.flatnonzero(since % UNIT_WORDS == 0)


def units_of(texts: list[str], line_words: int = LINE_WORDS) -> Units:
    """The units of some texts; runs of up to ``REACH`` words that stand alone are none."""
    owner, starts, ends, hashes = word_hashes(texts)
    data = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)
    line = np.cumsum(data == 10)[starts]
    # Lines of different texts are different lines.
    line = np.cumsum(np.append(False, (line[1:] != line[:-1]) | (owner[1:] != owner[:-1]))) if len(owner) else line
    block = _blocks(owner, line, line_words)
    first = _cuts(block, hashes)
    words = np.diff(np.append(first, len(hashes)))
    unit = np.repeat(np.arange(len(first)), words)
    found, _, shingles = shingle_hashes(unit, hashes)
    enough = words > REACH
    renumbered = np.cumsum(enough) - 1
    kept = enough[found]
    found, shingles = renumbered[found[kept]], shingles[kept]
    order = np.lexsort((shingles, found))
    found, shingles = found[order], shingles[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (shingles[1:] != shingles[:-1])
    found, shingles = found[new], shingles[new]
    # Code points before each byte, and before each text.
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    sizes = np.array([len(text) + 1 for text in texts], dtype=np.int64)
    offset = np.append(0, np.cumsum(sizes)[:-1]) if len(sizes) else sizes
    first, words = first[enough], words[enough]
    text = owner[first]
    if not len(first):
        return Units(text, first, first, first, words, shingles, found, first)
    numbers = np.arange(len(first)) - np.repeat(_runs(text), np.diff(np.append(_runs(text), len(text))))
    begin = points[starts[first]] - offset[text]
    end = points[ends[first + words - 1]] - offset[text]
    return Units(text, numbers, begin, end, words, shingles, found, _runs(found))


def _unit_rows(df: DataFrame, id_column: str, text_column: str, line_words: int) -> DataFrame:
    """A row per unit: where it is, and its class ``node``."""

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            units = units_of(part[text_column], line_words)
            if len(units.text):
                yield {
                    "node": units.digests(),
                    "id": [part[id_column][n] for n in units.text],
                    "row": [part[_ROW][n] for n in units.text],
                    "paragraph": units.number,
                    "begin": units.begin,
                    "end": units.end,
                    "n_words": units.n_words,
                }

        return work

    schema = f"node long, id {dict(df.dtypes)[id_column]}, row long, paragraph long, begin long, end long, n_words long"
    return map_slices(df, [id_column, _ROW, text_column], build, schema, text_column)


def _bands(df: DataFrame, text_column: str, line_words: int) -> DataFrame:
    """``sig, node``: the bands of every class, once however many copies it has."""
    names = [f"band{n}" for n in range(BANDS)]

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            units = units_of(part[text_column], line_words)
            if len(units.text):
                node, first = np.unique(units.digests(), return_index=True)
                yield {"node": node, **dict(zip(names, units.bands()[first].T))}

        return work

    schema = "node long, " + ", ".join(f"{name} long" for name in names)
    units = map_slices(df, [text_column], build, schema, text_column)
    classes = units.groupBy("node").agg(*(F.any_value(name).alias(name) for name in names))
    return classes.select(F.explode(F.array(*names)).alias("sig"), "node")


def _possible(one: str, two: str) -> Column:
    return sketches_allow(one, two, SKETCH_BITS)


def _sets_of(nodes: DataFrame, df: DataFrame, text_column: str, line_words: int) -> DataFrame:
    """``node, shingles, n, sketch`` of the given classes."""
    needed = membership_filter(nodes.select(hash_place("node").alias("place")))

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            units = units_of(part[text_column], line_words)
            if not len(units.text):
                return
            node, there = np.unique(units.digests(), return_index=True)
            found = in_filter(needed, node & (FILTER_BITS - 1))
            node, there = node[found], there[found]
            stop = np.append(units.at[1:], len(units.shingles))
            if len(there):
                yield {
                    "node": node,
                    "shingles": [signed(units.shingles[units.at[n] : stop[n]]) for n in there],
                    "n": units.sizes()[there],
                    "sketch": units.sketches()[there],
                }

        return work

    schema = "node long, shingles array<bigint>, n long, sketch long"
    sets = map_slices(df, [text_column], build, schema, text_column).join(nodes, "node", "left_semi")
    return sets.groupBy("node").agg(*(F.any_value(name).alias(name) for name in ("shingles", "n", "sketch")))


def repeated_paragraphs(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", line_words: int = LINE_WORDS
) -> DataFrame:
    """One row per unit that has a near copy, in another document or the same.

    ``id, paragraph`` (number of the unit in its text), ``begin, end`` (code
    points), ``n_words``, ``kept_doc_id, kept_paragraph`` (the cluster's first
    unit, a null id before all others), ``n_copies`` of the cluster, ``removed``
    (false for the one that stays). Empty and null texts have no units; repeated
    rows are copies of each other, of which one stays; an empty table gives an
    empty one. Classes and clusters are counted before anything is joined, so a
    passage that most documents share is a few classes.
    """
    found = _found(_marked(df.select(id_column, text_column)), id_column, text_column, line_words)
    return found.drop(_ROW)


def _marked(df: DataFrame) -> DataFrame:
    return df.withColumn(_ROW, F.monotonically_increasing_id())


def _found(df: DataFrame, id_column: str, text_column: str, line_words: int) -> DataFrame:
    """The rows of ``repeated_paragraphs`` with the mark of their row."""
    rows = materialise(_unit_rows(df, id_column, text_column, line_words))
    parts = _parts(df, text_column, line_words)
    copied = rows.groupBy("node").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("node")
    wanted = parts.join(copied, "node", "full_outer").select("node", F.coalesce("component_id", "node").alias("part"))
    # Units without a copy go before anything else is done with them.
    repeats = materialise(rows.join(wanted, "node").drop("node"))
    spot = F.struct("id", "row", "paragraph")
    clusters = repeats.groupBy("part").agg(F.min(spot).alias("kept"), F.count(F.lit(1)).alias("n_copies"))
    here = (F.col("row") == F.col("kept.row")) & (F.col("paragraph") == F.col("kept.paragraph"))
    return repeats.join(clusters, "part").select(
        F.col("row").alias(_ROW),
        F.col("id").alias(id_column),
        "paragraph",
        "begin",
        "end",
        "n_words",
        F.col("kept.id").alias("kept_doc_id"),
        F.col("kept.paragraph").alias("kept_paragraph"),
        "n_copies",
        (~here).alias("removed"),
    )


def _parts(df: DataFrame, text_column: str, line_words: int) -> DataFrame:
    """``node, component_id`` of the classes that have a near class, stored; what it took is deleted."""
    with scratch(df.sparkSession) as stored:
        buckets = shared_buckets(_bands(df, text_column, line_words))
        nodes = materialise(buckets.select("node").distinct())
        sets = materialise(_sets_of(nodes, df, text_column, line_words))
        facts = sets.select("node", "n", F.array("sketch").alias("sketch")).select("node", sketch_fact(SKETCH_BITS).alias("fact"))
        fetched = sets.select("node", "shingles")
        links = verified_links(buckets, lambda asked: fetched.join(asked, "node", "left_semi"), facts, _possible)
        parts = materialise(connected_components(links))
        stored.pop()
    return parts


@F.pandas_udf(StringType())
def _without(texts: pd.Series, cuts: pd.Series) -> pd.Series:
    """Each text without its spans and the white space that follows them."""

    def rest(text: str, spans) -> str:
        pieces, at = [], 0
        for span in sorted(spans, key=lambda s: s["begin"]):
            pieces.append(text[at : span["begin"]])
            at = span["end"]
            while at < len(text) and text[at] in " \t\n\x0b\x0c\r":
                at += 1
        return "".join(pieces) + text[at:]

    return pd.Series([text if spans is None else rest(text, spans) for text, spans in zip(texts, cuts)], dtype=object)


def remove_paragraphs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", line_words: int = LINE_WORDS) -> DataFrame:
    """``df`` with the repeated units cut out of ``text_column``; all rows and other columns stay.

    The white space after a unit goes with it.
    """
    rows = materialise(_marked(df))
    cuts = materialise(
        _found(rows, id_column, text_column, line_words)
        .where("removed")
        .groupBy(_ROW)
        .agg(F.collect_list(F.struct("begin", "end")).alias("__cut"))
    )
    return rows.join(cuts, _ROW, "left").withColumn(text_column, _without(text_column, "__cut")).select(*df.columns)
