"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search.

Words are runs of letters and digits, case folded; shingles of five words weigh
between 1 and 2 by the length of their words. Every window of about an item's
size that could reach the similarity is fingerprinted. Fingerprints are cut into
four blocks; one of them differs in at most a quarter of the radius, so items
are indexed under all near values of each block, and every pair within the
radius meets. Pairs are then placed and measured exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import (
    FILTER_BITS,
    SHINGLE_WORDS,
    filter_place,
    hash_place,
    in_filter,
    map_slices,
    membership_filter,
    mixed,
    shingle_hashes,
    signed,
    word_hashes,
)
from pulseledger.session import materialise

SIMILARITY = 0.75
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
# Windows have sizes in steps of this ratio; an item is compared with the nearest.
SIZE_RATIO = 1.03
# A similar window has at least 0.75 of its weight in shingles of the item; less here for the step in size.
LEAST_SHARED = 0.7

_NEAR = np.array(
    [sum(1 << bit for bit in bits) for count in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), count)],
    dtype=np.uint64,
)


def size_class(shingles: int) -> int:
    return round(math.log(shingles) / math.log(SIZE_RATIO))


def class_size(number: int) -> int:
    return max(1, round(SIZE_RATIO**number))


def _weighted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's shingles in order, and their weights."""
    owner, starts, ends, hashes = word_hashes([text.casefold() for text in texts], marks_part=True)
    text, first, found = shingle_hashes(owner, hashes)
    letters = np.append(0, np.cumsum(ends - starts))
    last = np.minimum(first + SHINGLE_WORDS, np.searchsorted(owner, owner[first], side="right")) if len(first) else first
    weights = 1 + np.clip((letters[last] - letters[first] - 15) / 20, 0, 1)
    cuts = np.searchsorted(text, np.arange(1, len(texts)))
    return zip(np.split(found, cuts), np.split(weights, cuts))


def _sums(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums of the weighted signs of every fingerprint bit."""
    bits = np.unpackbits(shingles[:, None].view(np.uint8), axis=1, bitorder="little")
    sums = np.zeros((len(shingles) + 1, 64))
    np.cumsum(np.where(bits, weights[:, None], -weights[:, None]), axis=0, out=sums[1:])
    return sums


def _prints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _keys(kind: int, prints: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Index keys per fingerprint: a row per block (and per near value)."""
    block = np.arange(BLOCKS, dtype=np.uint64)
    values = (prints[:, None] >> (block * np.uint64(BLOCK_BITS))) & np.uint64((1 << BLOCK_BITS) - 1)
    values = values[:, :, None] ^ near
    salt = (np.uint64(kind << 24) | (block << np.uint64(BLOCK_BITS)))[None, :, None]
    return signed(mixed(values | salt).reshape(len(prints), -1))


def index_items(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item, kind, print, keys, shingles, weights`` for every item that has words."""

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            out: dict[str, list] = {name: [] for name in ("item", "kind", "print", "keys", "shingles", "weights")}
            for item, (shingles, weights) in zip(part[id_column], _weighted(part[text_column])):
                if not len(shingles) or item is None:
                    continue
                kind = size_class(len(shingles))
                one = _prints(_sums(shingles, weights)[-1:])
                out["item"].append(item)
                out["kind"].append(kind)
                out["print"].append(signed(one)[0])
                out["keys"].append(_keys(kind, one, _NEAR)[0])
                out["shingles"].append(signed(shingles))
                out["weights"].append(weights)
            yield out

        return work

    schema = (
        f"item {dict(benchmark.dtypes)[id_column]}, kind int, print long, "
        "keys array<bigint>, shingles array<bigint>, weights array<double>"
    )
    return map_slices(benchmark, [id_column, text_column], build, schema, text_column)


def _windows(docs: DataFrame, kinds: list[int], known_shingles: np.ndarray, known_keys: np.ndarray) -> DataFrame:
    """``row, mark, kind, start, print, key`` of the windows that share enough shingles with the items.

    A row per block whose value may be in the index.
    """
    none = np.zeros(1, dtype=np.uint64)

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            for row, mark, (shingles, weights) in zip(part["row"], part["mark"], _weighted(part["text"])):
                known = in_filter(known_shingles, (shingles & np.uint64(FILTER_BITS - 1)).astype(np.int64))
                if not known.any():
                    continue
                shared, total = np.append(0, np.cumsum(weights * known)), np.append(0, np.cumsum(weights))
                sums = None
                for kind in kinds:
                    size = min(class_size(kind), len(shingles))
                    enough = shared[size:] - shared[:-size] >= LEAST_SHARED * (total[size:] - total[:-size])
                    starts = np.flatnonzero(enough)
                    if not len(starts):
                        continue
                    if sums is None:
                        sums = _sums(shingles, weights)
                    prints = _prints(sums[starts + size] - sums[starts])
                    keys = _keys(kind, prints, none)
                    window, block = np.nonzero(in_filter(known_keys, keys & (FILTER_BITS - 1)))
                    yield {
                        "row": [row] * len(window),
                        "mark": [mark] * len(window),
                        "kind": [kind] * len(window),
                        "start": starts[window],
                        "print": signed(prints)[window],
                        "key": keys[window, block],
                    }

        return work

    schema = "row long, mark long, kind int, start long, print long, key long"
    return map_slices(docs, ["row", "mark", "text"], build, schema)


def _similarity(shingles: np.ndarray, weights: np.ndarray, item: np.ndarray, item_weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    weight = {**dict(zip(item.tolist(), item_weights.tolist())), **dict(zip(shingles.tolist(), weights.tolist()))}
    one, two = Counter(shingles.tolist()), Counter(item.tolist())
    both = sum(weight[s] * n for s, n in (one & two).items())
    return both / sum(weight[s] * n for s, n in (one | two).items())


def best_window(
    shingles: np.ndarray, weights: np.ndarray, item: np.ndarray, item_weights: np.ndarray, low: int, high: int
) -> tuple[float, int]:
    """The most similar window of the item's own size that starts from ``low`` to ``high``; its similarity and start."""
    size = min(len(item), len(shingles))
    starts = np.arange(max(0, low), min(high, len(shingles) - size) + 1)
    if not len(starts):
        return 0.0, 0
    total = np.append(0, np.cumsum(weights))
    shared = np.append(0, np.cumsum(np.where(np.isin(shingles, item), weights, 0)))
    inside, common = total[starts + size] - total[starts], shared[starts + size] - shared[starts]
    # Repeats can only lower the common part, so this is an upper bound.
    bound = common / np.maximum(inside + item_weights.sum() - common, np.maximum(item_weights.sum(), inside))
    best, place = 0.0, int(starts[0])
    for n in np.argsort(-bound, kind="stable"):
        if bound[n] <= best:
            break
        at = int(starts[n])
        found = _similarity(shingles[at : at + size], weights[at : at + size], item, item_weights)
        if found > best:
            best, place = found, at
    return best, place


def _row_keys(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return df.select(F.col(id_column).alias("id"), text.alias("text")).select(
        "id", "text", F.xxhash64("id", "text").alias("row"), F.xxhash64(F.lit(1), "text", "id").alias("mark")
    )


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``id, row, mark, item, similarity, first_shingle, shingles``: passages like a benchmark item.

    One row per document row, item and place (windows within one window's
    length of each other count as one place). ``row`` and ``mark`` are hashes of
    id and text that tell document rows apart. Documents or items without words
    match nothing; a text shorter than an item is compared as a whole; items of
    fewer than five words match only texts that are just these words. Items
    without an id are ignored. Equal rows are reported once; empty tables give
    an empty one.
    """
    docs = _row_keys(df, id_column, text_column)
    items = materialise(index_items(benchmark, item_column))
    known = items.select(F.explode("shingles").alias("s")).select(hash_place("s").alias("place"))
    index = materialise(items.select("item", F.col("print").alias("item_print"), F.explode("keys").alias("key")))
    near_keys = membership_filter(index.select(hash_place("key").alias("place")))
    # Sizes in steps: a few dozen numbers whatever the number of items.
    kinds = sorted(row.kind for row in items.select("kind").distinct().collect())
    windows = materialise(
        _windows(docs.select("row", "mark", "text"), kinds, membership_filter(known), near_keys)
    )
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    met = (
        windows.join(index, "key")
        .where(apart <= RADIUS)
        .select("row", "mark", "item", "kind", "start", apart.alias("apart"))
    )
    size = F.greatest(F.lit(1), F.round(F.pow(F.lit(SIZE_RATIO), F.col("kind"))).cast("long"))
    places = materialise(
        met.withColumn("size", size)
        .groupBy("row", "mark", "item", "size", F.floor(F.col("start") / F.col("size")).alias("place"))
        .agg(F.min(F.struct("apart", "start")).alias("best"))
        .select("row", "mark", "item", "size", F.col("best.start").alias("start"))
    )
    measured = (
        places.join(items.select("item", F.col("shingles").alias("item_shingles"), "weights"), "item")
        .groupBy("row", "mark")
        .agg(F.collect_list(F.struct("item", "size", "start", "item_shingles", "weights")).alias("met"))
    )
    needed = membership_filter(places.select(filter_place("mark").alias("place")))
    near = docs.withColumn("place", filter_place("mark"))

    def keep(batches):
        for batch in batches:
            yield batch.filter(in_filter(needed, batch.column("place").to_numpy()).tolist())

    texts = near.mapInArrow(keep, near.schema).dropDuplicates(["row", "mark"]).join(measured, ["row", "mark"])

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            out: dict[str, list] = {
                name: [] for name in ("id", "row", "mark", "item", "similarity", "first_shingle", "shingles")
            }
            for key, row, mark, met, (shingles, weights) in zip(
                part["id"], part["row"], part["mark"], part["met"], _weighted(part["text"])
            ):
                for place in met:
                    item = np.array(place["item_shingles"], dtype=np.int64).view(np.uint64)
                    low, high = place["start"] - len(item), place["start"] + place["size"]
                    found, start = best_window(shingles, weights, item, np.array(place["weights"]), low, high)
                    if found >= similarity:
                        values = (key, row, mark, place["item"], found, start, min(len(item), len(shingles)))
                        for name, value in zip(out, values):
                            out[name].append(value)
            yield out

        return work

    schema = (
        f"id {dict(df.dtypes)[id_column]}, row long, mark long, item {dict(benchmark.dtypes)[item_column]}, "
        "similarity double, first_shingle long, shingles long"
    )
    found = map_slices(texts, ["id", "row", "mark", "text", "met"], build, schema)
    return found.distinct()


def remove_leaks(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` without a passage like a benchmark item; all columns unchanged."""
    found = materialise(leaks(df, benchmark, id_column, text_column).select("row", "mark").distinct())
    text = F.coalesce(F.col(text_column), F.lit(""))
    same = (F.xxhash64(id_column, text) == F.col("__row")) & (F.xxhash64(F.lit(1), text, id_column) == F.col("__mark"))
    return df.join(found.withColumnsRenamed({"row": "__row", "mark": "__mark"}), same, "left_anti")


def leak_report(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it, at its best place."""
    best = F.max(F.struct("similarity", (-F.col("first_shingle")).alias("before"), "shingles")).alias("best")
    return (
        leaks(df, benchmark)
        .groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))
        .agg(best)
        .select("doc_id", "item_id", F.col("best.similarity"), (-F.col("best.before")).alias("first_word"), "best.shingles")
    )
