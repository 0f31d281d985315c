"""Token counts at every prefix of a text, by dynamic programming over a byte-pair vocabulary.

The encoding of a prefix is the encoding of a shorter prefix and one more token,
so ``count[i] = count[i - len(t)] + 1``, where ``t`` is the one vocabulary piece
ending at ``i`` that the piece before it does not merge with. No piece spans a
blank or a line break, so a text falls into chunks and its table is the running
sum over them. The recurrence is solved once per distinct chunk, and its end is
compared with the library's count of that chunk. The whole text's count is the
last entry of its table; "how many tokens has this prefix" and "where must the
text be cut for a budget" are read from it without another encoding.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from pulseledger.llm.common import map_slices

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
# Distinct chunks remembered per task; beyond it the memory starts anew.
CACHE_CHUNKS = 1_000_000

_CHUNK = re.compile("▁*[^▁\n]*\n*")


# Where a nested table holds the pieces met on the way to it, longest first; no code point is empty.
PIECES = ""


def split(text: str) -> list[str]:
    """The chunks of a text, ▁ for blanks and one before it."""
    parts = _CHUNK.findall("▁" + text.replace(" ", "▁")) if text else []
    return parts[:-1] if parts and not parts[-1] else parts


class PrefixCounter:
    """Exact counts for every prefix, as sentencepiece gives them without added tokens."""

    def __init__(self, model_path: str) -> None:
        self._model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = self._model
        plain = (
            n
            for n in range(model.get_piece_size())
            if not (model.is_control(n) or model.is_unknown(n) or model.is_byte(n) or model.is_unused(n))
        )
        # Pieces read from their ends, a level of the nested tables per code point.
        self._endings: dict = {}
        for number in plain:
            piece = model.id_to_piece(number)
            if re.search("[^▁]▁|[\n ]", piece):
                raise ValueError("a piece of this vocabulary spans a blank or a line break")
            node = self._endings
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[PIECES] = ((len(piece), number),)
        levels = [(self._endings, ())]
        while levels:
            node, shorter = levels.pop()
            node[PIECES] = node.get(PIECES, ()) + shorter
            levels.extend((below, node[PIECES]) for character, below in node.items() if character != PIECES)
        self._pairs: dict[int, bool] = {}
        self._chunks: dict[str, np.ndarray] = {}
        self._totals: dict[str, int] = {}
        self.differing = 0

    def _encoded(self, inner: str) -> list[str]:
        """The pieces of a text written with ▁ for blanks, no blank added before it."""
        if inner.startswith("▁"):
            return self._model.encode(inner[1:], out_type=str) or ["▁"]
        return self._model.encode("\n" + inner, out_type=str)[2:]

    def _lengths(self, inners: list[str]) -> list[int]:
        """The number of pieces of each, as ``_encoded`` gives them."""
        texts = [inner[1:] if inner.startswith("▁") else "\n" + inner for inner in inners]
        found = [len(ids) for ids in self._model.encode(texts, num_threads=1)] if texts else []
        # Before a line break stand two pieces; a blank alone is one, though the library gives none.
        return [
            count - 2 if not inner.startswith("▁") else count or 1 for inner, count in zip(inners, found)
        ]

    def _stands(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when they meet."""
        inner = self._model.id_to_piece(left) + self._model.id_to_piece(right)
        if inner.startswith("▁"):
            return self._model.encode(inner[1:]) == [left, right]
        return self._model.encode("\n" + inner)[2:] == [left, right]

    def _extend(self, chunk: str, counts: list[int], last: list[int]) -> None:
        """Continue ``counts`` and the ``last`` pieces of a beginning of the chunk to its end."""
        endings, pairs = self._endings, self._pairs
        for end in range(len(counts), len(chunk) + 1):
            node, start = endings, end
            while start and (longer := node.get(chunk[start - 1])) is not None:
                node = longer
                start -= 1
            for size, piece in node[PIECES]:
                start = end - size
                before = last[start]
                if before >= 0:
                    key = before << 32 | piece
                    stands = pairs.get(key)
                    if stands is None:
                        stands = pairs[key] = self._stands(before, piece)
                    if not stands:
                        continue
                last.append(piece)
                counts.append(counts[start] + 1)
                break
            else:
                # Not in the vocabulary: one token per UTF-8 byte, merging with nothing.
                last.append(-1)
                counts.append(counts[end - 1] + len(chunk[end - 1].encode()))

    def _recurrence(self, chunk: str) -> list[int]:
        """Counts of the chunk's prefixes of 0, 1, 2, ... code points."""
        counts, last = [0], [-1]
        self._extend(chunk, counts, last)
        return counts

    def learn(self, chunks: Iterable[str]) -> None:
        """The last entries of the tables of chunks not met before.

        In sorted order, so that a table is continued from the beginning it shares
        with the one before.
        """
        if len(self._totals) > CACHE_CHUNKS:
            self._totals.clear()
        if len(self._pairs) > CACHE_CHUNKS:
            self._pairs.clear()
        new = sorted(chunk for chunk in set(chunks) if chunk not in self._totals)
        found, known, counts, last = [], "", [0], [-1]
        for chunk in new:
            same = next((n for n, (a, b) in enumerate(zip(known, chunk)) if a != b), min(len(known), len(chunk)))
            del counts[same + 1 :], last[same + 1 :]
            self._extend(chunk, counts, last)
            found.append(counts[-1])
            known = chunk
        # The library decides, should a piece merge by another rule.
        exact = self._lengths(new)
        self.differing += sum(map(operator.ne, found, exact))
        self._totals.update(zip(new, exact))

    def chunk(self, chunk: str) -> np.ndarray:
        """Counts of the chunk's prefixes of 1, 2, ... code points."""
        known = self._chunks.get(chunk)
        if known is None:
            if len(self._chunks) > CACHE_CHUNKS:
                self._chunks.clear()
            counts = self._recurrence(chunk)
            if counts[-1] != len(self._encoded(chunk)):
                # Ask the library prefix by prefix.
                counts = [len(self._encoded(chunk[:end])) for end in range(len(chunk) + 1)]
            known = self._chunks[chunk] = np.array(counts[1:], dtype=np.int64)
        return known

    def chunks(self, text: str) -> tuple[list[str], np.ndarray]:
        """The text's chunks and the running sum of their counts."""
        parts = split(text)
        self.learn(parts)
        return parts, self._sums(parts)

    def _sums(self, parts: list[str]) -> np.ndarray:
        return np.cumsum(np.fromiter(map(self._totals.__getitem__, parts), np.int64, len(parts)))

    def all_chunks(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """``chunks`` of each text; tables are worked out for all of them at once."""
        lists = [split(text) for text in texts]
        self.learn(chain.from_iterable(lists))
        return ((parts, self._sums(parts)) for parts in lists)

    def table(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ..., len(text) code points."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        parts, tokens = self.chunks(text)
        before = np.concatenate([[0], tokens[:-1]])
        counts = np.concatenate([self.chunk(part) + base for part, base in zip(parts, before)])
        counts[0] = 0
        return counts

    def cut(self, parts: list[str], tokens: np.ndarray, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens, from the tables alone."""
        nth = int(np.searchsorted(tokens, budget, side="right"))
        # The blank before the text is no code point of it.
        longest = sum(map(len, parts[:nth])) - 1
        if nth < len(parts):
            base = int(tokens[nth - 1]) if nth else 0
            fitting = np.flatnonzero(self.chunk(parts[nth]) + base <= budget)
            if len(fitting):
                longest += 1 + int(fitting[-1])
        return max(longest, 0)


def count_tokens(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    model: str = MODEL,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit, cut_chars``.

    ``cut_chars`` is the length in code points of the longest prefix within
    ``limit`` tokens. Null texts count as empty (0 tokens, cut 0); a null id,
    repeated rows and other columns change nothing; an empty table gives an
    empty one. Memory holds a slice of texts and bounded caches of chunks.
    """
    path = public_tokenizers.path(model)

    def build():
        counter = PrefixCounter(path)

        def work(part: dict[str, list]) -> Iterator[dict]:
            totals, cuts = [], []
            for text, (parts, tokens) in zip(part[text_column], counter.all_chunks(part[text_column])):
                totals.append(int(tokens[-1]) if parts else 0)
                cuts.append(len(text) if totals[-1] <= limit else counter.cut(parts, tokens, limit))
            yield {
                id_column: part[id_column],
                "n_bytes": [len(text.encode()) for text in part[text_column]],
                "n_tokens": totals,
                "over_limit": [total > limit for total in totals],
                "cut_chars": cuts,
            }

        return work

    schema = f"`{id_column}` {dict(df.dtypes)[id_column]}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    return map_slices(df, [id_column, text_column], build, schema, text_column)


def prefix_tables(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL
) -> DataFrame:
    """``id, prefix_tokens``: the count of every prefix (element ``i``: ``i`` code points).

    Null and empty texts give ``[0]``.
    """
    path = public_tokenizers.path(model)

    def build():
        counter = PrefixCounter(path)

        def work(part: dict[str, list]) -> Iterator[dict]:
            for key, text in zip(part[id_column], part[text_column]):
                yield {id_column: [key], "prefix_tokens": [counter.table(text)]}

        return work

    schema = f"`{id_column}` {dict(df.dtypes)[id_column]}, prefix_tokens array<bigint>"
    return map_slices(df, [id_column, text_column], build, schema, text_column)
