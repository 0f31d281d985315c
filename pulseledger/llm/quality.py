"""Quality of texts by a generalised additive model with pairwise interactions.

Every feature is cut into bins; its effect is a table with one number per bin,
and a few pairs of features have small two-way tables. The tables are learned by
cyclic boosting: in turn, each feature (later each pair) gets a shallow tree over
its bins, fitted to what the others leave unexplained and added with a small
step. A score is a sum of table entries.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import filter_slices, map_slices

THRESHOLD = 0.3
# Labelled rows the model is fitted on, at most, in the order of a hash of their ids.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 48, 8
CYCLES, PAIR_CYCLES, PAIRS = 160, 60, 6
STEP, RIDGE = 0.1, 2.0

FEATURES = (
    "characters", "words", "word_length", "upper", "punctuation", "symbols", "digits", "blanks", "distinct",
    "commonest", "doubled", "line_length", "worst_line", "repeated_lines", "stops", "beyond_ascii", "compressed",
)

_CLASS = {
    "upper": string.ascii_uppercase,
    "letters": string.ascii_letters,
    "punctuation": string.punctuation,
    "symbols": "!#$%&*|<>^~\\{}[]",
    "digits": string.digits,
    "blanks": string.whitespace,
}
_MEMBERS = np.zeros((256, len(_CLASS)))
for _n, _members in enumerate(_CLASS.values()):
    _MEMBERS[np.frombuffer(_members.encode(), dtype=np.uint8), _n] = 1
_LINE_LEAST = 20


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text, from the whole text; an empty text gives zeros."""
    rows = np.zeros((len(texts), len(FEATURES)))
    for row, text in zip(rows, texts):
        data = text.encode("utf-8", "surrogatepass")
        words = data.split()
        if not words:
            row[0] = np.log1p(len(data))
            continue
        counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
        upper, letters, punctuation, symbols, digits, blanks = counts @ _MEMBERS
        size, n = len(data), len(words)
        seen = Counter(words)
        lines = [line for line in text.split("\n") if line.strip()]
        odd = 0.0
        for line in lines:
            if len(line) >= _LINE_LEAST:
                raw = np.frombuffer(line.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                share = np.bincount(raw, minlength=256) @ _MEMBERS[:, [0, 3]]
                odd = max(odd, share.max() / len(raw))
        row[:] = (
            np.log1p(len(text)),
            np.log1p(n),
            (size - blanks) / n,
            upper / max(letters, 1),
            punctuation / size,
            symbols / size,
            digits / size,
            blanks / size,
            len(seen) / n,
            max(seen.values()) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            np.log1p(len(text) / max(len(lines), 1)),
            odd,
            1 - len(set(lines)) / max(len(lines), 1),
            counts[ord(".")] / n,
            counts[128:].sum() / size,
            len(zlib.compress(data, 1)) / size,
        )
    return rows


@dataclass(frozen=True)
class Model:
    """Bin edges and tables. ``pairs`` holds ``first, second, table``."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of a good text per row, by additions of table entries."""
        total = np.full(len(values), self.base)
        for n, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, n], side="right")]
        for first, second, table in self.pairs:
            one = np.searchsorted(self.pair_edges[first], values[:, first], side="right")
            two = np.searchsorted(self.pair_edges[second], values[:, second], side="right")
            total += table[one, two]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient * gradient / (weight + RIDGE)


def _tree(gradient: np.ndarray, weight: np.ndarray, splits: int = 3) -> np.ndarray:
    """A tree with ``splits`` cuts over a feature's bins; its value in every bin."""
    leaves = [(0, len(gradient))]
    above_g, above_w = np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(weight))
    for _ in range(splits):
        best, chosen = 1e-9, None
        for low, high in leaves:
            cuts = np.arange(low + 1, high)
            if not len(cuts):
                continue
            left_g, left_w = above_g[cuts] - above_g[low], above_w[cuts] - above_w[low]
            all_g, all_w = above_g[high] - above_g[low], above_w[high] - above_w[low]
            gains = _gain(left_g, left_w) + _gain(all_g - left_g, all_w - left_w) - _gain(all_g, all_w)
            at = int(np.argmax(gains))
            if gains[at] > best:
                best, chosen = gains[at], (low, int(cuts[at]), high)
        if chosen is None:
            break
        low, cut, high = chosen
        leaves.remove((low, high))
        leaves += [(low, cut), (cut, high)]
    values = np.zeros(len(gradient))
    for low, high in leaves:
        values[low:high] = (above_g[high] - above_g[low]) / (above_w[high] - above_w[low] + RIDGE)
    return values


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut on each axis; its gain and its value in every cell."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    rows, columns = g.shape
    if rows < 2 or columns < 2:
        return 0.0, np.zeros_like(gradient)

    def quarters(x: np.ndarray) -> tuple[np.ndarray, ...]:
        a = x[:-1, :-1]
        b, c = x[:-1, -1:] - a, x[-1:, :-1] - a
        return a, b, c, x[-1, -1] - a - b - c

    parts = list(zip(quarters(g), quarters(w)))
    gains = sum(_gain(*part) for part in parts)
    at = np.unravel_index(int(np.argmax(gains)), gains.shape)
    a, b, c, d = (part_g[at] / (part_w[at] + RIDGE) for part_g, part_w in parts)
    row, column = np.arange(rows)[:, None] <= at[0], np.arange(columns)[None, :] <= at[1]
    cells = np.where(row, np.where(column, a, b), np.where(column, c, d))
    return float(gains[at] - _gain(g[-1, -1], w[-1, -1])), cells


def fit_tables(values: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting on logistic loss. Without both labels the score is constant."""
    width = len(FEATURES)
    if len(labels) == 0 or labels.min() == labels.max():
        base = 0.0 if len(labels) == 0 else float(np.where(labels[0] == 1, 4.0, -4.0))
        none = [np.empty(0)] * width
        return Model(base, none, [np.zeros(1)] * width, none, [])
    share = labels.mean()
    base = float(np.log(share / (1 - share)))
    edges = [_edges(values[:, n], BINS) for n in range(width)]
    bins = [np.searchsorted(edges[n], values[:, n], side="right") for n in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(labels), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(CYCLES):
        for n in range(width):
            gradient, weight = slopes()
            size = len(tables[n])
            tree = _tree(np.bincount(bins[n], gradient, size), np.bincount(bins[n], weight, size))
            tables[n] += STEP * tree
            total += STEP * tree[bins[n]]

    coarse = [_edges(values[:, n], PAIR_BINS) for n in range(width)]
    cells = [np.searchsorted(coarse[n], values[:, n], side="right") for n in range(width)]

    def pair_tree(one: int, two: int) -> tuple[float, np.ndarray]:
        gradient, weight = slopes()
        shape = (len(coarse[one]) + 1, len(coarse[two]) + 1)
        cell = cells[one] * shape[1] + cells[two]
        flat = shape[0] * shape[1]
        return _pair_tree(
            np.bincount(cell, gradient, flat).reshape(shape), np.bincount(cell, weight, flat).reshape(shape)
        )

    ranked = sorted(
        ((-pair_tree(one, two)[0], one, two) for one in range(width) for two in range(one + 1, width))
    )
    pairs = [(one, two, np.zeros((len(coarse[one]) + 1, len(coarse[two]) + 1))) for _, one, two in ranked[:PAIRS]]
    for _ in range(PAIR_CYCLES):
        for one, two, table in pairs:
            _, tree = pair_tree(one, two)
            table += STEP * tree
            total += STEP * tree[cells[one], cells[two]]
    return Model(base, edges, tables, coarse, pairs)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fifth.

    Held out are ids whose crc32 (as text) leaves remainder 0 modulo 5. Rows
    without an id or label are ignored. The feature rows (2.7 MB at the default
    bound) come to the driver; texts do not. Only the text enters a feature.
    """
    usable = labels.where(
        F.col(label).isNotNull() & F.col(id_column).isNotNull() & (F.crc32(F.col(id_column).cast("string")) % 5 != 0)
    ).select(F.col(id_column).alias("__id"), F.col(label).cast("int").alias("__label"))
    sample = usable.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    # Texts do not move: at most sample_rows ids (a third of a megabyte) go to them.
    chosen = texts.join(F.broadcast(sample), "__id").select("__id", "__text", "__label")

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            yield {"id": list(map(str, part["__id"])), "label": part["__label"], "x": list(features(part["__text"]))}

        return work

    rows = map_slices(chosen, ["__id", "__text", "__label"], build, "id string, label int, x array<double>", "__text").collect()
    rows.sort(key=lambda row: (row.id, row.label, row.x))
    values = np.array([row.x for row in rows]).reshape(len(rows), len(FEATURES))
    return fit_tables(values, np.array([row.label for row in rows], dtype=float))


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` per row: 0 to 1, higher for better texts.

    Null texts are scored like empty ones; repeated rows each get the same
    score; an empty table gives an empty one.
    """

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            yield {id_column: part[id_column], "score": model.score(features(part[text_column]))}

        return work

    schema = f"`{id_column}` {dict(df.dtypes)[id_column]}, score double"
    return map_slices(df, [id_column, text_column], build, schema, text_column)


def keep_good(df: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` scored at least ``threshold``, all columns unchanged."""
    return filter_slices(df, lambda: lambda texts: model.score(features(texts)) >= threshold, text_column)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
