"""Helpers shared by the operators: passes over texts, hashed word shingles, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pulseledger.session import materialise

# Bytes of text and rows handed to numpy at once; bound a worker's memory whatever the batch size.
SLICE_CHARS, SLICE_ROWS = 400_000, 2_000
SHINGLE_WORDS = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with about ``SLICE_CHARS`` bytes of text each; a longer text is alone."""
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(sizes):
        stop, room = start, SLICE_CHARS
        while stop < min(len(sizes), start + SLICE_ROWS) and (stop == start or room >= sizes[stop]):
            room -= sizes[stop]
            stop += 1
        yield start, stop
        start = stop


def _filled(texts: pa.Array) -> list[str]:
    return ["" if text is None else text for text in texts.to_pylist()]


def map_slices(
    df: DataFrame,
    columns: Sequence[str],
    build: Callable[[], Callable[[dict[str, list]], Iterator[dict[str, list | np.ndarray]]]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Run a function over the rows of ``df``, some hundred texts at a time.

    ``build`` makes the function once per task (models and caches live in it). It
    gets a dict of lists (null texts arrive as empty texts) and yields dicts of
    columns named in ``schema``.
    """
    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def encoded(out: dict[str, list | np.ndarray]) -> pa.RecordBatch:
        arrays = [pa.array(out[field.name], field.type) for field in target]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for batch in batches:
            data = dict(zip(columns, batch.columns))
            for start, stop in _slices(data[text]):
                cut = {name: column.slice(start, stop - start) for name, column in data.items()}
                part = {name: _filled(column) if name == text else column.to_pylist() for name, column in cut.items()}
                yield from map(encoded, work(part))

    return df.select(*columns).mapInArrow(run, schema)


def filter_slices(
    df: DataFrame, build: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text"
) -> DataFrame:
    """The rows of ``df`` whose texts a function keeps; every column passes unchanged.

    ``build`` makes the function once per task; it gets a list of texts (nulls as
    empty texts) and returns a boolean for each.
    """
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = build()
        for batch in batches:
            for start, stop in _slices(batch.column(place)):
                part = batch.slice(start, stop - start)
                yield part.filter(pa.array(keep(_filled(part.column(place))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser; spreads every input bit over the whole word."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _ODD, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


# Inverse of the multiplier modulo 2**64, by Newton's iteration.
def _inverse(odd: int) -> int:
    found = odd
    for _ in range(6):
        found = found * (2 - odd * found) % (1 << 64)
    return found


_UNODD = np.uint64(_inverse(int(_ODD)))
_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
# ASCII white space: tab to carriage return, and blank.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_MARKS = _SPACE.copy()
_MARKS[[code for code in range(33, 127) if not chr(code).isalnum()]] = True


def word_hashes(
    texts: Sequence[str], marks_part: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts: their text's number, byte start, byte end and 64-bit hash.

    Words are runs without ASCII white space (``marks_part``: nor ASCII
    punctuation), A-Z lower-cased. Starts and ends count in the UTF-8 bytes of
    the texts joined by one blank.
    """
    data = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)
    lengths = np.array([len(text.encode("utf-8", "surrogatepass")) + 1 for text in texts], dtype=np.int64)
    ends_of_texts = np.cumsum(lengths)
    gap = (_MARKS if marks_part else _SPACE)[data]
    inside = ~gap
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = edge[0::2], edge[1::2]
    power = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[_LOWER[data]] * power[:-1], out=total[1:])
    undo = np.full(len(data) + 1, _UNODD, dtype=np.uint64)
    undo[:1] = 1
    undo = np.multiply.accumulate(undo)
    hashes = mixed((total[ends] - total[starts]) * undo[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(ends_of_texts, starts, side="right")
    return owner, starts, ends, hashes


def shingle_hashes(
    owner: np.ndarray, hashes: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed runs of ``size`` words within each text: text number, first word, hash.

    A text with fewer words gives one run of all its words.
    """
    none = np.empty(0, dtype=np.int64)
    if not len(hashes):
        return none, none, np.empty(0, dtype=np.uint64)
    length = len(hashes)
    total = np.zeros(length, dtype=np.uint64)
    whole = np.zeros(length, dtype=bool)
    if length >= size:
        whole[: length - size + 1] = owner[: length - size + 1] == owner[size - 1 :]
    for step in range(min(size, length)):
        part = mixed(hashes + np.uint64((step + 1) * int(_ODD) % (1 << 64)))
        total[: length - step] += part[step:] if step else part
    first = np.flatnonzero(whole)
    found = mixed(total[first] ^ np.uint64(size))
    # Texts with fewer words than one run.
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    counts = np.diff(np.append(begin, length))
    short = np.flatnonzero(counts < size)
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for place, n in enumerate(short):
            at, count = begin[n], counts[n]
            steps = np.arange(1, count + 1, dtype=np.uint64) * _ODD
            extra[place] = mixed(np.add.reduce(mixed(hashes[at : at + count] + steps), keepdims=True) ^ np.uint64(count))[0]
        first = np.concatenate([first, begin[short]])
        found = np.concatenate([found, extra])
        order = np.argsort(first, kind="stable")
        first, found = first[order], found[order]
    return owner[first], first, found


def distinct_shingles(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: text number and hash, in this order."""
    owner, _, _, hashes = word_hashes(texts)
    text, _, found = shingle_hashes(owner, hashes)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return text[new], found[new]


def shingle_sets(texts: Sequence[str]) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    text, found = distinct_shingles(texts)
    return np.split(found, np.searchsorted(text, np.arange(1, len(texts))))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component_id`` for every node of ``edges`` (columns ``a``, ``b``, any order).

    Every round points each node at the smallest of its neighbours and itself,
    follows those pointers to their ends, and joins the remaining edges on the
    ends. Rounds are stored in the shared folder, so a lost executor costs one
    round. Hot nodes are met by partial minima and by joins of two stored
    tables, which adaptive execution can split.
    """
    edges = materialise(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialise(nodes.select("node", F.col("node").alias("component_id")))
    while not edges.isEmpty():
        both = edges.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("node"), F.col("a").alias("near")),
                    F.struct(F.col("b").alias("node"), F.col("a").alias("near")),
                )
            ).alias("e")
        ).select("e.*")
        parents = materialise(both.groupBy("node").agg(F.min("near").alias("parent")))
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            parents = materialise(
                parents.join(above, "parent").select(
                    "node", F.col("top").alias("parent"), (F.col("top") != F.col("parent")).alias("moved")
                )
            )
            if parents.where("moved").isEmpty():
                break
            parents = parents.select("node", "parent")
        ends = parents.select(F.col("node").alias("component_id"), "parent")
        labels = materialise(
            labels.join(ends, "component_id", "left").select(
                "node", F.coalesce("parent", "component_id").alias("component_id")
            )
        )
        low = parents.select(F.col("node").alias("a"), F.col("parent").alias("low"))
        high = parents.select(F.col("node").alias("b"), F.col("parent").alias("high"))
        edges = materialise(
            edges.join(low, "a")
            .join(high, "b")
            .where("low <> high")
            .select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b"))
            .distinct()
        )
    return labels


def numbered_within(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``nth``: each row's place (from 0) among the rows of its ``key``.

    A range sort over key and order, then counts per (partition, key): a key
    holding most rows spans many partitions and meets no single task. Ties in
    ``order`` beyond equal rows get an arbitrary but stored order.
    """
    position = F.monotonically_increasing_id()
    placed = materialise(
        df.orderBy(F.col(key).asc_nulls_first(), *order)
        .select("*", position.alias("__position"))
        .withColumn("__partition", F.shiftright("__position", 33))
    )
    counts = placed.groupBy(key, "__partition").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__position").alias("__first")
    )
    earlier = Window.partitionBy(key).orderBy("__partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        counts.select(
            F.col(key).alias("__key"),
            F.col("__partition").alias("__at"),
            "__first",
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"),
        )
    )
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__partition") == F.col("__at"))
    nth = (F.col("__offset") + F.col("__position") - F.col("__first")).alias("nth")
    return placed.join(offsets, same).select(*df.columns, nth)


FILTER_BITS = 1 << 23


def filter_place(key: str) -> Column:
    """A key's place in the filter that ``membership_filter`` builds."""
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def hash_place(key: str) -> Column:
    """The same for a column that is a hash already; numpy finds it by the low bits."""
    return F.pmod(key, F.lit(FILTER_BITS))


def membership_filter(places: DataFrame, place: str = "place") -> np.ndarray:
    """A bitmap of places, one megabyte whatever their number: no member is missed.

    It spares work on rows that a later exact join would drop anyway.
    """
    word = F.expr(f"{place} div 64").alias("word")
    bit = F.expr(f"shiftleft(1L, cast({place} % 64 as int))")
    bitmap = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in places.groupBy(word).agg(F.bit_or(bit).alias("bits")).collect():
        bitmap[row.word] = row.bits
    return bitmap.view(np.uint64)


def in_filter(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def parity_sketches(owner: np.ndarray, shingles: np.ndarray, count: int, bits: int) -> np.ndarray:
    """For each set, whether an odd number of its shingles falls on each of so many bits, as longs.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    place = owner * bits + (mixed(shingles + np.uint64(7)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(place, minlength=count * bits).reshape(count, bits) % 2
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def sketch_fact(bits: int) -> Column:
    """A struct of ``n`` and the words of the array ``sketch``."""
    return F.struct("n", *(F.element_at("sketch", n + 1).alias(f"s{n}") for n in range(bits // 64)))


def sketch_distance(one: str, two: str, bits: int) -> Column:
    """Sketch bits in which two facts differ."""
    return sum((F.bit_count(F.col(one)[f"s{n}"].bitwiseXOR(F.col(two)[f"s{n}"])) for n in range(bits // 64)), F.lit(0))


def sketches_allow(one: str, two: str, bits: int) -> Column:
    """Whether sizes and sketches leave a similarity of 3/4 possible; no similar pair is denied."""
    n_one, n_two = F.col(one)["n"], F.col(two)["n"]
    total = n_one + n_two
    return (7 * F.least(n_one, n_two) >= 3 * total) & (7 * sketch_distance(one, two, bits) <= total)


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``sig, node, first`` of buckets with several nodes, stored; ``first`` is the smallest.

    Rows without a ``sig`` are passed on.
    """
    bucket = Window.partitionBy("sig")
    return materialise(
        rows.withColumns({"first": F.min("node").over(bucket), "last": F.max("node").over(bucket)})
        .where("first <> last or sig is null")
        .drop("last")
    )


# Rounds in which buckets get a further centre before members are compared with each other: at most so
# many, and another one only if one in so many comparisons of the last gave a link.
CENTRES, WORTHWHILE = 8, 20


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (``a, b, ...``; stored) whose sets have 100 * intersection >= 75 * union."""

    def side(column: str, name: str) -> DataFrame:
        # Sets that no pair asks for stay where they are.
        asked = pairs.select(F.col(column).alias("node")).distinct()
        return sets.join(asked, "node", "left_semi").select(F.col("node").alias(column), F.col("shingles").alias(name))

    left, right = side("a", "left"), side("b", "right")
    both = F.size(F.array_intersect("left", "right"))
    together = F.size("left") + F.size("right") - both
    alike = (100 * both >= 75 * together) & (both > 0)
    return pairs.join(right, "b").join(left, "a").where(alike).select(*pairs.columns)


def _open_buckets(members: DataFrame) -> DataFrame:
    """The rows ``sig, node, part, ...`` of buckets whose members are in several parts, stored."""
    several = members.groupBy("sig").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return materialise(members.join(several.select("sig"), "sig", "left_semi"))


def verified_links(
    shared: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    facts: DataFrame,
    possible: Callable[[str, str], Column],
    far: Callable[[str, str], Column] = lambda centre, node: F.lit(False),
    lean: Callable[[str], Column] = F.col,
    lean_possible: Callable[[str, str], Column] | None = None,
    at_once: bool = False,
) -> DataFrame:
    """Links ``a, b`` that connect exactly what the similar pairs within buckets connect.

    Every member of a bucket is first compared with the bucket's smallest node,
    its centre. Buckets whose members are then in several components get further
    centres, drawn by a hash of the node, so that overlapping buckets draw the
    same: members outside the centre's component are compared with it. A round
    is linear in the members, and what one centre misses another links. Only
    members that no round has brought into their bucket's components are
    compared with each other, unless they are ``far`` from the first centre:
    then they cannot be similar to anything linked to it. Buckets of equal
    members count once, and pairs already in one component are left out.

    ``facts`` has a row per ``node`` with a struct ``fact``; ``possible`` says of
    two such columns whether the pair can be similar at all. ``lean`` makes of a
    fact the smaller one that travels with every row of an open bucket, for
    ``lean_possible``. ``sets_of`` gives ``node, shingles`` for a table of nodes; ``at_once`` asks
    it once for every node that shares a bucket, which suits small sets.
    """
    lean_possible = lean_possible or possible

    def known(rows: DataFrame, column: str) -> DataFrame:
        return rows.join(facts.select(F.col("node").alias(column), F.col("fact").alias(f"fact_{column}")), column)

    def nodes_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def with_sets(sets: DataFrame, pairs: DataFrame) -> DataFrame:
        wanted = materialise(nodes_of(pairs).join(sets.select("node"), "node", "left_anti"))
        return sets if wanted.isEmpty() else sets.unionByName(materialise(sets_of(wanted)))

    pairs = materialise(shared.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    if pairs.isEmpty():
        return pairs
    stars = materialise(
        known(known(pairs, "a"), "b").select(
            "a", "b", possible("fact_a", "fact_b").alias("near"), far("fact_a", "fact_b").alias("far")
        )
    )
    near = materialise(stars.where("near").select("a", "b").distinct())
    sets = materialise(sets_of(materialise(nodes_of(pairs if at_once else near))))
    links = materialise(_similar(near, sets))
    parts = connected_components(links)

    def part_of(column: str, name: str) -> DataFrame:
        return parts.select(F.col("node").alias(column), F.col("component_id").alias(name))

    unsettled = materialise(
        stars.groupBy("a", "b")
        .agg(F.min("far").alias("far"))
        .join(links, ["a", "b"], "left_anti")
        .join(part_of("a", "pa"), "a", "left")
        .join(part_of("b", "pb"), "b", "left")
        .select(
            F.col("a").alias("first"),
            F.col("b").alias("node"),
            (F.coalesce("pa", "a") != F.coalesce("pb", "b")).alias("apart"),
            "far",
        )
    )
    loose = materialise(shared.join(unsettled, ["first", "node"]).select("sig", "node", "apart", "far"))
    apart = loose.where("apart").select("sig").distinct()
    closer = materialise(loose.where("apart and not far").select("sig").distinct())
    # The first centre has been compared with everyone; what is linked to it need not meet what is far from it.
    settled = shared.where("node <> first").join(closer, "sig", "left_semi").select("sig", "node")
    settled = settled.join(loose, ["sig", "node"], "left_anti").distinct()
    told = loose.join(materialise(apart), "sig", "left_semi").groupBy("sig", "node").agg(F.min("far").alias("far"))
    others = told.select("sig", "node", F.lit(True).alias("loose"), "far").unionByName(
        settled.select("sig", "node", F.lit(False).alias("loose"), F.lit(False).alias("far"))
    )
    others = materialise(
        others.join(part_of("node", "part"), "node", "left").select("sig", "node", "loose", "far", F.coalesce("part", "node").alias("part"))
    )
    # Of buckets with equal members one is enough; 128 bits tell them apart.
    mark = [F.bit_xor(F.xxhash64(F.lit(salt), "node", "loose", "far")).alias(f"mark{salt}") for salt in (1, 2)]
    marks = others.groupBy("sig").agg(*mark, F.min("part").alias("low"), F.max("part").alias("high"))
    single = marks.where("low <> high").groupBy("mark1", "mark2").agg(F.min("sig").alias("sig"))
    members = materialise(others.join(single.select("sig"), "sig", "left_semi"))
    facts = materialise(facts.join(members.select("node").distinct(), "node", "left_semi"))

    for n in range(CENTRES):
        if members.isEmpty():
            return links
        drawn = F.struct(F.xxhash64(F.lit(n), "node").alias("draw"), F.col("node").alias("a"), F.col("part").alias("pa"))
        centres = members.groupBy("sig").agg(F.min(drawn).alias("centre")).select("sig", "centre.a", "centre.pa")
        met = members.join(centres, "sig").where("part <> pa")
        met = materialise(met.select("a", "pa", F.col("node").alias("b"), F.col("part").alias("pb")).distinct())
        fit = materialise(known(known(met, "a"), "b").where(possible("fact_a", "fact_b")).select(*met.columns))
        sets = with_sets(sets, fit)
        found = materialise(_similar(fit, sets))
        linked = found.count()
        if linked:
            links = links.unionByName(found.select("a", "b"))
            joined = connected_components(found.select(F.col("pa").alias("a"), F.col("pb").alias("b")))
            joined = joined.select(F.col("node").alias("part"), F.col("component_id").alias("now"))
            moved = members.join(joined, "part", "left").withColumn("part", F.coalesce("now", "part")).drop("now")
            members = _open_buckets(moved)
        if linked * WORTHWHILE < met.count():
            break

    rest = materialise(members.join(facts.select("node", lean("fact").alias("fact")), "node"))
    one = rest.where("loose").select("sig", F.col("node").alias("a"), F.col("part").alias("pa"), "far", F.col("fact").alias("fact_a"))
    two = rest.select("sig", "loose", F.col("node").alias("b"), F.col("part").alias("pb"), F.col("fact").alias("fact_b"))
    due = F.when(two.loose, F.col("a") < F.col("b")).otherwise(~one.far) & (F.col("pa") != F.col("pb"))
    met = one.join(two, (one.sig == two.sig) & due & lean_possible("fact_a", "fact_b"))
    met = materialise(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    fit = materialise(known(known(met, "a"), "b").where(possible("fact_a", "fact_b")).select("a", "b").distinct())
    return links.unionByName(materialise(_similar(fit, with_sets(sets, fit))))
