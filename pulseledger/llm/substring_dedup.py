"""Removal of every byte covered by a string of 400 bytes that also starts elsewhere.

Texts are not sorted as a whole. Each window of 400 bytes is filed under its
smallest hashed 16-gram, an anchor that equal windows share at the same offset.
Windows of one anchor and one quarter of the offsets form a segment; the bytes
common to all of them are its key, so equal windows have equal keys. Keys met
once need no further look, and segments that are equal as wholes repeat in full.
What remains, different segments under one key, is compared through a
Burrows-Wheeler transform per shard of keys (a key too large for a shard, such
as the edge of a passage that most texts share, is split down to its windows,
where equal strings need no further comparison): intervals of suffixes grow by
backward extension, breadth first, and mark where neighbouring suffixes part
after 0, 1, 2, ... bytes. Growth stops at 400; neighbours never parted agree on
at least that much.

Hashes that stand for bytes are 128 bits long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import (
    _BYTE_CODES,
    _UNODD,
    _powers,
    filter_place,
    in_filter,
    map_slices,
    membership_filter,
    mixed,
    signed,
)
from pulseledger.session import materialise

LENGTH = 400
GRAM = 16
QUARTERS = 4
# Segments are narrowed to runs of so many offsets before they are sorted.
NARROW = 24
# Bytes of segments that one transform is built over.
SHARD_BYTES = 250_000
# Keys with more bytes of different segments than this are split into single windows.
SPLIT_BYTES = 1_000_000
# Windows of so many bytes of text are worked on at once; places in them have to fit into PLACE_BITS.
PIECE_BYTES = 1 << 22
PLACE_BITS = 24


class _Prefix:
    """Polynomial prefix hashes of a byte string; any substring's hash takes one step."""

    def __init__(self, data: np.ndarray) -> None:
        self.power = _powers(len(data) + 1)
        self.undo = np.full(len(data) + 1, _UNODD, dtype=np.uint64)
        self.undo[:1] = 1
        self.undo = np.multiply.accumulate(self.undo)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * self.power[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.undo[start])


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` grams, the place of the smallest; the first of equal ones."""
    size = len(grams)
    if size > 1 << PLACE_BITS:
        raise ValueError(f"{size} grams do not fit into {PLACE_BITS} bits")
    low = np.uint64(PLACE_BITS)
    place = np.arange(size, dtype=np.uint64)
    valued = (grams >> low << low) | place
    blocks = -(-size // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:size] = valued
    rows = padded.reshape(blocks, span)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: size - span + 1], before[span - 1 : size])
    return (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def _pieces(texts: list[bytes], length: int, piece: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Numbers, starts and bytes of texts, cut so that every window is in one piece; some ``piece`` bytes at once."""
    numbers, begins, cuts, room = [], [], [], piece
    for number, text in enumerate(texts):
        for begin in range(0, max(len(text) - length + 1, 1), piece):
            cut = text[begin : begin + piece + length - 1]
            if cuts and len(cut) > room:
                yield numbers, begins, cuts
                numbers, begins, cuts, room = [], [], [], piece
            numbers.append(number)
            begins.append(begin)
            cuts.append(cut)
            room -= len(cut)
    if cuts:
        yield numbers, begins, cuts


def segments(texts: list[bytes], length: int, piece: int = PIECE_BYTES) -> dict[str, np.ndarray]:
    """All segments of the texts, as ``_segments`` gives them.

    A long text is cut into pieces that share ``length - 1`` bytes. A window's
    anchor and key follow from its own bytes, so a cut parts a segment in two
    of one key and changes nothing else.
    """
    parts = []
    for numbers, begins, cuts in _pieces(texts, length, piece):
        found = _segments(cuts, length)
        found["first"] = found["first"] + np.array(begins, dtype=np.int64)[found["text"]]
        found["text"] = np.array(numbers, dtype=np.int64)[found["text"]]
        parts.append(found)
    if len(parts) == 1:
        return parts[0]
    parts = parts or [_segments([], length)]
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}


def _segments(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """All segments of texts of no more than ``2**PLACE_BITS`` bytes together.

    ``text`` number, ``first`` window's start in it, ``windows``, the first
    window's ``offset`` before the anchor, ``key``, and ``low``/``high``, the
    digest of the segment's bytes and offsets.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    span = length - GRAM + 1
    names = ("text", "first", "windows", "offset", "key", "low", "high")
    if len(data) < length:
        return {name: np.empty(0, dtype=np.int64) for name in names}
    prefix = _Prefix(data)
    starts = np.arange(len(data) - GRAM + 1)
    grams = prefix.of(starts, starts + GRAM)
    gram_sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(grams + np.uint64(1)))])
    anchor = _anchors(grams, span)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    window = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
    anchor, owner = anchor[window], owner[window]
    step = -(-span // QUARTERS)
    quarter = (anchor - window) // step
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (quarter[1:] != quarter[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    low, high = window[begin], window[np.append(begin[1:], len(window)) - 1]
    anchor, quarter, owner = anchor[begin], quarter[begin], owner[begin]
    # Bytes every window with such an offset covers.
    most = np.minimum((quarter + 1) * step, span) - 1
    key = prefix.of(anchor - quarter * step, anchor + length - most)
    offset = anchor - low
    shape = mixed((offset * (1 << 20) + (high - low)).astype(np.uint64))
    return {
        "text": owner,
        "first": low - (ends - sizes)[owner],
        "windows": high - low + 1,
        "offset": offset,
        "key": signed(mixed(key + quarter.astype(np.uint64))),
        "low": signed(prefix.of(low, high + length) ^ shape),
        "high": signed(mixed(gram_sums[high + length - GRAM + 1] - gram_sums[low]) + shape),
    }


def _suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and each suffix's rank, by doubling the compared length."""
    size = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    reach = 1
    while True:
        second = np.zeros(size, dtype=np.int64)
        second[: size - reach] = rank[reach:] + 1
        combined = rank * (size + 1) + second
        order = np.argsort(combined, kind="stable")
        sorted_keys = combined[order]
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_keys[1:] != sorted_keys[:-1]))
        if rank[order[-1]] == size - 1 or reach >= size:
            return order, rank
        reach *= 2


def parted_before(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for each place whether it parts from the place before within ``length``.

    Interval expansion: an interval holds the suffixes that start with one
    string; put before it each symbol that precedes them in the text, and the
    new intervals' ends are places that part after that string's length. A place
    already marked parted earlier, so its interval is not grown again.
    """
    order, rank = _suffix_order(symbols)
    size = len(symbols)
    # Where the suffix one symbol longer stands: backward extension through the transform.
    back = rank[order - 1]
    first = symbols[order]
    parted = np.zeros(size + 1, dtype=bool)
    parted[[0, size]] = True
    low, high = np.array([0]), np.array([size])
    for _ in range(length):
        sizes = high - low
        inside = np.repeat(low - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        source = np.repeat(np.arange(len(low)), sizes)
        target = back[inside]
        by_target = np.argsort(target, kind="stable")
        target, source = target[by_target], source[by_target]
        symbol = first[target]
        ends = np.ones(len(target), dtype=bool)
        ends[:-1] = (target[1:] != target[:-1] + 1) | (source[1:] != source[:-1]) | (symbol[1:] != symbol[:-1])
        last = np.flatnonzero(ends)
        begin = np.append(0, last[:-1] + 1)
        new_low, new_high = target[begin], target[last] + 1
        fresh = ~parted[new_high]
        # The last interval of all ends where the order ends; it still has to grow.
        fresh |= new_high == size
        parted[new_high] = True
        low, high = new_low[fresh], new_high[fresh]
        if not len(low):
            break
    return order, parted


def repeated_windows(
    parts: list[bytes], windows: list[int], offsets: list[int], length: int
) -> list[np.ndarray]:
    """For each segment, which of its windows also occur in another segment (or again in itself)."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    prefix = _Prefix(data)
    counts = np.array(windows, dtype=np.int64)
    begins = np.cumsum([0] + [len(part) for part in parts[:-1]])
    number = np.repeat(np.arange(len(parts)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.append(0, np.cumsum(counts)[:-1]), counts)
    place = begins[number] + nth
    offset = np.array(offsets)[number] - nth
    # Narrow runs of offsets whose common bytes occur once hold no repeats.
    narrow = offset // NARROW
    top = np.minimum((narrow + 1) * NARROW, length - GRAM + 1) - 1
    common = prefix.of(place + offset - narrow * NARROW, place + offset + length - top)
    common = mixed(common + narrow.astype(np.uint64))
    _, inverse = np.unique(common, return_inverse=True)
    pairs = np.unique(inverse * np.int64(len(parts)) + number)
    alive = np.bincount(pairs // len(parts), minlength=inverse.max() + 1)[inverse] > 1
    result = np.zeros(len(place), dtype=bool)
    live = np.flatnonzero(alive)
    if len(live):
        new = np.ones(len(live), dtype=bool)
        new[1:] = (live[1:] != live[:-1] + 1) | (number[live[1:]] != number[live[:-1]])
        first = np.flatnonzero(new)
        run_low, run_high = place[live[first]], place[live[np.append(first[1:], len(live)) - 1]] + length
        sizes = run_high - run_low
        # Every run ends with a symbol of its own, so nothing matches across runs.
        where = np.append(0, np.cumsum(sizes + 1))
        symbols = np.empty(where[-1], dtype=np.int64)
        within = np.arange(sizes.sum()) - np.repeat(np.append(0, np.cumsum(sizes)[:-1]), sizes)
        symbols[np.repeat(where[:-1], sizes) + within] = data[np.repeat(run_low, sizes) + within].astype(np.int64) + len(sizes)
        symbols[where[1:] - 1] = np.arange(len(sizes))
        order, parted = parted_before(symbols, length)
        together = np.empty(len(symbols), dtype=bool)
        together[order] = ~parted[:-1] | ~parted[1:]
        run = np.cumsum(new) - 1
        result[live] = together[where[run] + place[live] - run_low[run]]
    return np.split(result, np.cumsum(counts)[:-1])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]


def _segment_rows(docs: DataFrame, length: int) -> DataFrame:
    """Rows ``kind 0``: a segment (``met``: 2 if a task met it more than once); ``kind 1``: windows repeated for sure."""

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            texts = [text.encode("utf-8", "surrogatepass") for text in part["text"]]
            found = segments(texts, length)
            if not len(found["key"]):
                return
            ids, marks = np.array(part["row"], dtype=np.int64), np.array(part["mark"], dtype=np.int64)
            order = np.lexsort((found["high"], found["low"], found["key"]))
            found = {name: values[order] for name, values in found.items()}
            new = np.ones(len(order), dtype=bool)
            new[1:] = (
                (found["key"][1:] != found["key"][:-1])
                | (found["low"][1:] != found["low"][:-1])
                | (found["high"][1:] != found["high"][:-1])
            )
            group = np.cumsum(new) - 1
            met = np.bincount(group)
            one = np.flatnonzero(new)
            text = found["text"][one]
            yield {
                "kind": np.zeros(len(one)),
                "row": ids[text],
                "mark": marks[text],
                **{name: found[name][one] for name in ("first", "windows", "offset", "key", "low", "high")},
                "met": np.minimum(met, 2),
            }
            # Map-side: windows met twice are repeated; adjoining ones become one row.
            again = np.flatnonzero(met[group] > 1)
            if len(again):
                text, first = found["text"][again], found["first"][again]
                last = first + found["windows"][again]
                by_place = np.lexsort((first, text))
                text, first, last = text[by_place], first[by_place], last[by_place]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (first[1:] != last[:-1])
                begin = np.flatnonzero(new)
                last = last[np.append(begin[1:], len(text)) - 1]
                zero = np.zeros(len(begin))
                yield {
                    "kind": zero + 1,
                    "row": ids[text[begin]],
                    "mark": marks[text[begin]],
                    "first": first[begin],
                    "windows": last - first[begin],
                    "offset": zero, "key": zero, "low": zero, "high": zero, "met": zero,
                }

        return work

    schema = "kind int, row long, mark long, first long, windows long, offset long, key long, low long, high long, met int"
    return map_slices(docs, ["row", "mark", "text"], build, schema)


def _window_hashes(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for every window of the bytes."""
    prefix = _Prefix(np.frombuffer(data, dtype=np.uint8))
    starts = np.arange(len(data) - length + 1)
    places = np.arange(len(data) - GRAM + 1)
    sums = np.append(np.uint64(0), np.cumsum(mixed(prefix.of(places, places + GRAM) + np.uint64(1))))
    return signed(prefix.of(starts, starts + length)), signed(mixed(sums[starts + length - GRAM + 1] - sums[starts]))


def _split_windows(parts: DataFrame) -> DataFrame:
    """``key, low, high, begin, end``: windows of large keys that occur more than once, one by one."""
    each = parts.select(
        "key", "low", "high", F.posexplode(F.arrays_zip("h1", "h2")).alias("begin", "h")
    ).select("key", "low", "high", F.col("begin").cast("long").alias("begin"), "h.h1", "h.h2")
    again = materialise(each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return each.join(again, ["h1", "h2"]).select("key", "low", "high", "begin", (F.col("begin") + 1).alias("end"))


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``key, low, high, windows, offset`` of the wanted segments, with their ``bytes`` or, if ``large``, window hashes ``h1, h2``."""
    needed = membership_filter(wanted.select(filter_place("mark").alias("place")))
    per_text = wanted.groupBy("row", "mark").agg(
        F.collect_list(F.struct("key", "low", "high", "first", "windows", "offset", "large")).alias("wanted")
    )
    place = docs.withColumn("place", filter_place("mark"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(needed, batch.column("place").to_numpy())))

    texts = place.mapInArrow(keep, place.schema).join(per_text, ["row", "mark"]).select("text", "wanted")
    names = ("key", "low", "high", "windows", "offset")

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            out: dict[str, list] = {name: [] for name in (*names, "bytes", "h1", "h2")}
            for text, listed in zip(part["text"], part["wanted"]):
                data = text.encode("utf-8", "surrogatepass")
                for item in listed:
                    for name in names:
                        out[name].append(item[name])
                    cut = data[item["first"] : item["first"] + item["windows"] - 1 + length]
                    one, two = _window_hashes(cut, length) if item["large"] else (None, None)
                    for name, value in zip(("bytes", "h1", "h2"), (None if item["large"] else cut, one, two)):
                        out[name].append(value)
            yield out

        return work

    schema = "key long, low long, high long, windows long, offset long, bytes binary, h1 array<bigint>, h2 array<bigint>"
    return map_slices(texts, ["text", "wanted"], build, schema)


def _compared(parts: DataFrame, length: int) -> DataFrame:
    """``key, low, high, begin, end``: runs of windows that another segment under the key has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            masks = repeated_windows(
                [r["bytes"] for r in held], [r["windows"] for r in held], [r["offset"] for r in held], length
            )
            rows = [
                (r["key"], r["low"], r["high"], int(begin), int(end))
                for r, mask in zip(held, masks)
                for begin, end in zip(*_runs(mask))
            ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "low", "high", "begin", "end"])

        for batch in batches:
            for row in batch.to_pylist():
                if size > SHARD_BYTES and row["key"] != held[-1]["key"]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield flush()

    shards = parts.repartition("key").sortWithinPartitions("key", "low", "high")
    return shards.mapInArrow(run, "key long, low long, high long, begin long, end long")


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row, mark, begin, end``: starts of repeated windows in each text (bytes, end exclusive)."""
    every = materialise(_segment_rows(docs, length))
    rows = every.where("kind = 0").drop("kind")
    sure = every.where("kind = 1").select("row", "mark", F.col("first").alias("begin"), (F.col("first") + F.col("windows")).alias("end"))

    digest = F.struct("low", "high")
    keys = rows.groupBy("key").agg(F.sum("met").alias("times"), F.min(digest).alias("a"), F.max(digest).alias("b"))
    shared = materialise(keys.where("times > 1").select("key", (F.col("a") != F.col("b")).alias("several")))
    members = materialise(rows.join(shared, "key"))
    whole = F.col("first") + F.col("windows")
    # All segments under the key are one: every window repeats.
    alike = members.where("not several").select("row", "mark", F.col("first").alias("begin"), whole.alias("end"))
    mixed_up = members.where("several")
    one_each = materialise(
        mixed_up.groupBy("key", "low", "high").agg(
            F.sum("met").alias("times"), F.min(F.struct("row", "mark", "first", "windows", "offset")).alias("one")
        )
    )
    volume = one_each.groupBy("key").agg(F.sum(F.col("one.windows") + length - 1).alias("volume"))
    sized = one_each.join(materialise(volume), "key")
    wanted = sized.select("key", "low", "high", "one.*", (F.col("volume") > SPLIT_BYTES).alias("large"))
    parts = materialise(_with_bytes(docs, materialise(wanted), length))
    shards = parts.where("bytes is not null").drop("h1", "h2")
    compared = _compared(shards, length).unionByName(_split_windows(parts.where("bytes is null")))
    twice = one_each.where("times > 1").select("key", "low", "high", F.lit(0).cast("long").alias("begin"), F.col("one.windows").alias("end"))
    known = materialise(compared.unionByName(twice))
    differing = mixed_up.join(known, ["key", "low", "high"]).select(
        "row", "mark", (F.col("first") + F.col("begin")).alias("begin"), (F.col("first") + F.col("end")).alias("end")
    )
    return sure.unionByName(alike).unionByName(differing)


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256, removed`` per input row.

    Every byte covered by a ``length``-byte string that also starts anywhere
    else in the input, the same text included, is removed; ``removed`` lists the
    maximal runs ``begin, end`` in UTF-8 bytes of the input text. Texts shorter
    than ``length``, empty and null texts lose nothing. Rows that repeat as
    wholes, id and text, are separate texts and lose everything. Null ids are
    ids like others. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    docs = df.select(F.col(id_column).alias("id"), text.alias("text")).select(
        "id", "text", F.xxhash64("id", "text").alias("row"), F.xxhash64(F.lit(1), "text", "id").alias("mark")
    )
    starts = materialise(repeated_ranges(docs.select("row", "mark", "text"), length))
    per_text = starts.groupBy("row", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("starts"))

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            out: dict[str, list] = {name: [] for name in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")}
            for key, value, ranges in zip(part["id"], part["text"], part["starts"]):
                data = value.encode("utf-8", "surrogatepass")
                spans: list[dict] = []
                for begin, end in sorted((r["begin"], r["end"] + length - 1) for r in ranges or ()):
                    if spans and begin <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], end)
                    else:
                        spans.append({"begin": begin, "end": end})
                kept = hashlib.sha256()
                at = 0
                for span in spans:
                    kept.update(data[at : span["begin"]])
                    at = span["end"]
                kept.update(data[at:])
                out["id"].append(key)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(span["end"] - span["begin"] for span in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(kept.hexdigest())
                out["removed"].append(spans)
            yield out

        return work

    schema = (
        f"id {dict(df.dtypes)[id_column]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<struct<begin: bigint, end: bigint>>"
    )
    joined = docs.join(per_text, ["row", "mark"], "left")
    return map_slices(joined, ["id", "text", "starts"], build, schema).withColumnRenamed("id", id_column)
