"""Exact Jaccard join of documents on word shingles, by universe partition and pigeonhole.

Shingles are hashed into the segments of a size band. Sets with Jaccard
similarity of at least 3/4 differ in at most ``(s + t) / 7`` shingles, so of any
``H + 1`` of its segments a set shares at least one, unchanged, with every
partner. Each set indexes only the cheapest ``H + 1`` segments it has: the order
depends on a segment's content alone (common shingles last, then many shingles
first), so two sets agree on it and the one that stops first is enough. Small
sets, whose segments would often be empty, use half as many segments and also
index each with one shingle left out, which finds segments that differ by one.
Sets with fewer than ``H + 1`` segments that hold anything are partitioned anew
among themselves, until none is left.

Documents that share a segment are checked exactly. First every member of a
bucket is compared with the bucket's smallest document, then, where members are
in different components, with further documents drawn from the bucket; what is
still apart is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import (
    connected_components,
    distinct_shingles,
    filter_place,
    in_filter,
    map_slices,
    membership_filter,
    mixed,
    parity_sketches,
    shared_buckets,
    shingle_sets,
    signed,
    sketch_distance,
    sketch_fact,
    sketches_allow,
    verified_links,
)
from pulseledger.session import materialise

SMALL = 64
# Bits of the sketch that bounds how much two sets differ before they are fetched.
SKETCH_BITS, LEAN_BITS = 2048, 1024
# Sets of more shingles than the sketch has bits fill it, so they have a wider one besides.
WIDE_BITS = 16_384
# Common shingles: every slice of texts reports its commonest, their counts are added up, and the
# commonest of all are sent to the tasks (half a megabyte). They only decide which segments are indexed.
REPORTED, COMMON = 1 << 12, 1 << 16


def _commonest(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several of a slice's sets have, and how many; at most ``REPORTED``."""
    keys, counts = np.unique(shingles, return_counts=True)
    top = np.argsort(-counts, kind="stable")[:REPORTED]
    top = top[counts[top] > 1]
    return keys[top], counts[top]


def _digest(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows ``kind, id, n, low, high, sketch, wide``: 0 a document's set size and fingerprint, 1 a common shingle."""

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            count = len(part[id_column])
            owner, shingles = distinct_shingles(part[text_column])
            starts = np.searchsorted(owner, np.arange(count))
            sums = [np.append(0, np.cumsum(mixed(shingles + np.uint64(salt)))) for salt in (1, 2)]
            ends = np.append(starts[1:], len(owner))
            low, high = (signed(total[ends] - total[starts]) for total in sums)
            wide: list = [None] * count
            large = np.flatnonzero(ends - starts > SKETCH_BITS)
            if len(large):
                chosen = np.isin(owner, large)
                renamed = np.searchsorted(large, owner[chosen])
                for at, sketch in zip(large, parity_sketches(renamed, shingles[chosen], len(large), WIDE_BITS)):
                    wide[at] = sketch
            yield {
                "kind": [0] * count,
                "id": part[id_column],
                "n": ends - starts,
                "low": low,
                "high": high,
                "sketch": list(parity_sketches(owner, shingles, count, SKETCH_BITS)),
                "wide": wide,
            }
            keys, counts = _commonest(shingles)
            none = [None] * len(keys)
            yield {"kind": [1] * len(keys), "id": none, "n": counts, "low": signed(keys), "high": none, "sketch": none, "wide": none}

        return work

    schema = f"kind int, id {dict(df.dtypes)[id_column]}, n long, low long, high long, sketch array<bigint>, wide array<bigint>"
    return map_slices(df, [id_column, text_column], build, schema, text_column)


def allowed_difference(size: int | np.ndarray) -> int | np.ndarray:
    """The largest symmetric difference to any set within similarity 3/4."""
    return (size + 4 * size // 3) // 7


def signatures(
    owner: np.ndarray, shingles: np.ndarray, sizes: np.ndarray, common: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of many sets at once: set number, signature; and the sets with too few segments in a band.

    Bands are powers of two; a set also enters the next band if a partner may be there.
    """
    band_of = np.frexp(np.maximum(sizes - 1, 0))[1]
    reaches = 4 * sizes > 3 * (1 << band_of)
    least = allowed_difference(sizes) + 1
    rare = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles if len(common) else np.ones(len(shingles), dtype=bool)
    owners, found, lacking = [], [], np.zeros(len(sizes), dtype=bool)
    for band in np.unique(np.concatenate([band_of, band_of[reaches] + 1])):
        members = (sizes > 0) & ((band_of == band) | (reaches & (band_of + 1 == band)))
        chosen = members[owner]
        if not chosen.any():
            continue
        top = 1 << int(band)
        whole = top > SMALL
        count = top // 2 if whole else max(2, (3 * top) // 10)
        key = mixed(np.array([(salt << 8) + int(band) + 1], dtype=np.uint64))
        spread = mixed(shingles[chosen] ^ key)
        segment = owner[chosen] * count + (spread >> np.uint64(11)).astype(np.int64) % count
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        widths = np.diff(np.append(starts, len(segment)))
        tokens = mixed(spread[order] + np.uint64(1))
        content = np.add.reduceat(tokens, starts)
        base = mixed((segment[starts] % count).astype(np.uint64) + key)
        exact = mixed(content + base)
        of = segment[starts] // count
        if whole:
            lacking |= members & (np.bincount(of, minlength=len(sizes)) < least)
            rares = np.add.reduceat(rare[chosen][order].astype(np.int64), starts)
            cheapest = np.lexsort((exact, -widths, rares == 0, of))
            of, exact = of[cheapest], exact[cheapest]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
            kept = place < least[of]
            owners.append(of[kept])
            found.append(exact[kept])
        else:
            # A lone shingle is found if the partner has it, several also if they differ by one.
            units = np.bincount(of, 1.0 + (widths > 1), minlength=len(sizes))
            lacking |= members & (units < least)
            at = np.repeat(np.arange(len(starts)), widths)
            several = widths[at] > 1
            owners += [of, of[at][several]]
            found += [exact, mixed(content[at] - tokens + base[at])[several]]
    none = np.empty(0, dtype=np.int64)
    return (
        np.concatenate([none, *owners]),
        np.concatenate([none.view(np.uint64), *found]),
        np.flatnonzero(lacking),
    )


def _signature_rows(df: DataFrame, id_column: str, text_column: str, common: np.ndarray, salt: int) -> DataFrame:
    """``sig, node`` rows; a row without a signature names a document to be partitioned anew."""

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            docs = np.array(part[id_column], dtype=np.int64)
            owner, shingles = distinct_shingles(part[text_column])
            sizes = np.bincount(owner, minlength=len(docs))
            of, found, again = signatures(owner, shingles, sizes, common, salt)
            yield {"sig": signed(found), "node": docs[of]}
            if len(again):
                yield {"sig": [None] * len(again), "node": docs[again]}

        return work

    return map_slices(df, [id_column, text_column], build, "sig long, node long", text_column)


def _possible(one: str, two: str) -> Column:
    both = F.zip_with(F.col(one)["wide"], F.col(two)["wide"], lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(both, F.lit(0), lambda total, x: total + x)
    wide_enough = F.coalesce(7 * apart <= F.col(one)["n"] + F.col(two)["n"], F.lit(True))
    return sketches_allow(one, two, SKETCH_BITS) & wide_enough


def _folded(fact: str) -> Column:
    """The fact with its sketch folded to ``LEAN_BITS``: the parities of bits a multiple apart, together."""
    words, every = LEAN_BITS // 64, SKETCH_BITS // 64

    def fold(n: int) -> Column:
        word = F.col(fact)[f"s{n}"]
        for more in range(n + words, every, words):
            word = word.bitwiseXOR(F.col(fact)[f"s{more}"])
        return word.alias(f"s{n}")

    return F.struct(F.col(fact)["n"].alias("n"), *(fold(n) for n in range(words)))


def _folded_possible(one: str, two: str) -> Column:
    return sketches_allow(one, two, LEAN_BITS)


def _far(centre: str, node: str) -> Column:
    """Whether the node is too far from the centre to be similar to anything the centre is similar to.

    Differences obey the triangle inequality: something similar to the centre
    has at most 4/3 of its size, differs from it in a seventh of both sizes, and
    would have to differ from the node in no more than a seventh of theirs.
    """
    return 21 * sketch_distance(centre, node, SKETCH_BITS) > 3 * F.col(node)["n"] + 11 * F.col(centre)["n"]


def _sets_of(nodes: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``node, shingles`` of the given documents, one row per text.

    The filter spares work on most other texts, the semi-join drops the rest
    before anything is stored.
    """
    needed = membership_filter(nodes.select(filter_place("node").alias("place")))

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            there = in_filter(needed, np.array(part["place"], dtype=np.int64))
            texts = [text for text, wanted in zip(part[text_column], there) if wanted]
            if texts:
                yield {
                    "node": [doc for doc, wanted in zip(part[id_column], there) if wanted],
                    "shingles": [signed(s) for s in shingle_sets(texts)],
                }

        return work

    placed = docs.withColumn("place", filter_place(id_column))
    sets = map_slices(placed, [id_column, text_column, "place"], build, "node long, shingles array<bigint>", text_column)
    return sets.join(nodes, "node", "left_semi")


def jaccard_components(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` per input row.

    Links join documents whose sets of five-word shingles (fewer words: the
    whole sequence) have similarity 0.75 or more; ``component_id`` is the
    smallest id reachable by links. Empty and null texts have no shingles and
    are alone. Rows of one id count as one document: if any of them links, all
    are in the component. Rows without an id get a null component and link with
    nothing. An empty table gives an empty one. Ids are whole numbers. Hot
    groups of copies are one representative each before anything is joined.
    """
    docs = df.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    digest = materialise(_digest(docs, "doc", "text"))
    sized = digest.where("kind = 0")
    counted = digest.where("kind = 1").groupBy("low").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "low").limit(COMMON).collect()
    common = np.sort(np.array([row.low for row in top], dtype=np.int64).view(np.uint64))

    named = sized.where("id is not null and n > 0")
    classes = materialise(named.groupBy("n", "low", "high").agg(F.min("id").alias("a"), F.max("id").alias("b")))
    copied = classes.where("a <> b").select("n", "low", "high", "a")
    copies = materialise(
        named.join(copied, ["n", "low", "high"]).where("id <> a").select("a", F.col("id").alias("b")).distinct()
    )
    # A document is left to its representative only if no row of it represents a class.
    ends = classes.select(F.col("a").alias("b"))
    spare = copies.select("b").distinct().join(ends, "b", "left_anti").select(F.col("b").alias("doc"))
    kept = docs.where("doc is not null").join(spare, "doc", "left_anti")

    fact = sketch_fact(SKETCH_BITS).withField("wide", F.col("wide"))
    facts = named.select(F.col("id").alias("node"), fact.alias("fact"))

    links = materialise(copies.select("a", "b"))
    salt, rest = 0, kept
    while True:
        rows = _signature_rows(rest, "doc", "text", common, salt)
        buckets = shared_buckets(rows)
        found = verified_links(
            buckets.where("sig is not null"),
            lambda nodes: _sets_of(nodes, kept, "doc", "text"),
            facts,
            _possible,
            _far,
            _folded,
            _folded_possible,
        )
        links = links.unionByName(found)
        again = buckets.where("sig is null").select(F.col("node").alias("doc")).distinct()
        if again.isEmpty():
            break
        salt += 1
        rest = kept.join(again, "doc", "left_semi")
    parts = connected_components(links)
    found = sized.select(F.col("id").alias("node"), F.col("n").alias("n_shingles")).join(parts, "node", "left")
    return found.select(
        F.col("node").cast(dict(df.dtypes)[id_column]).alias(id_column),
        "n_shingles",
        F.coalesce("component_id", "node").cast(dict(df.dtypes)[id_column]).alias("component_id"),
    )
