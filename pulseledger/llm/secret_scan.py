"""Secrets in texts: fixed patterns, and strings that a primed zstandard can't compress.

A candidate is a long run of key-like characters shortly after a sensitive word.
Its novelty is what it adds to the compressed size of its surroundings, with a
dictionary of the corpus's own identifiers at hand, per byte. Words and
identifiers known from the corpus or repeated nearby add little; random keys add
almost their entropy.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import map_slices

# The base kinds, in the order used for ties.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)|pwd|secret|token|credential|bearer|authorization|private|(?:api|access|signing|encryption)[ _-]?key",
    re.IGNORECASE | re.ASCII,
)
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "credential", "bearer", "authorization", "private", "key")

LEAST_RUN = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~.-]{%d,}" % LEAST_RUN)
KEY_RUN = re.compile(r"[A-Za-z0-9+/_=~.-]+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,}")
# How far after a sensitive word a candidate may start, and how much text around it is compared.
REACH, CONTEXT = 48, 160
# Compressed bytes added per byte of the candidate; random hexadecimal digits need at least 0.5.
NOVELTY = 0.48
DICTIONARY_WORDS = 8192
LEVEL = 19


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the base kinds, in code points."""
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def candidates(text: str) -> list[tuple[int, int]]:
    """Long key-like runs that start shortly after a sensitive word and mix letters with digits.

    A run that itself holds sensitive words is a candidate from the first and
    from the last place after one. Every run is read once.
    """
    low = text.lower()
    if not any(word in low for word in SENSITIVE_WORDS):
        return []
    starts: dict[int, tuple[int, int]] = {}
    runs: list[int] = []
    ends: list[int] = []
    for word in SENSITIVE.finditer(text):
        at, last = word.end(), word.end() + REACH
        n = bisect_right(ends, at)
        while True:
            if n == len(ends):
                m = CANDIDATE.search(text, at, last + LEAST_RUN)
                if not m:
                    break
                runs.append(m.start())
                ends.append(CANDIDATE.match(text, m.start()).end())
            # The word may stand before a run found earlier or inside it.
            start, end = max(at, runs[n]), ends[n]
            if start > last:
                break
            if end - start >= LEAST_RUN:
                starts[end] = (starts.get(end, (start,))[0], start)
            at, n = end, n + 1
    found = {(start, end) for end, both in starts.items() for start in both}
    return sorted((start, end) for start, end in found if _mixed(text[start:end]))


def _mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def known_words(text: str) -> set[str]:
    """Identifiers near the sensitive words of a text, without any part of a string that could be a key."""
    if not any(word in text.lower() for word in SENSITIVE_WORDS):
        return set()
    words: set[str] = set()
    done = 0
    for m in SENSITIVE.finditer(text):
        # Runs are taken whole where they reach into the surroundings, and once where surroundings overlap.
        low, high = max(done, m.start() - CONTEXT), m.end() + CONTEXT
        if low >= high:
            continue
        while low > done and KEY_RUN.match(text[low - 1]):
            low -= 1
        for run in KEY_RUN.finditer(text, low):
            if run.start() >= high:
                break
            done = run.end()
            if len(run[0]) < 16 or not _mixed(run[0]):
                words.update(word for word in IDENTIFIER.findall(run[0]) if len(word) <= 32)
    return words


def identifiers(df: DataFrame, text_column: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The corpus's commonest identifiers near sensitive words, commonest first.

    Counted once per distinct text, over all texts: neither copies of a text nor
    repeats within one make a string known, and what could be a key never is.
    ``words`` bounds what reaches the driver (about 100 KB).
    """

    def build():
        def work(part: dict[str, list]) -> Iterator[dict]:
            found = {}
            for text in dict.fromkeys(part[text_column]):
                if known := known_words(text):
                    found[hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16]] = sorted(known)
            if found:
                yield {"digest": list(found), "words": list(found.values())}

        return work

    met = map_slices(df, [text_column], build, "digest binary, words array<string>", text_column)
    texts = met.groupBy("digest").agg(F.any_value("words").alias("words"))
    counted = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # The dictionary holds what different texts share.
    common = counted.where("n > 1")
    return [row.word for row in common.orderBy(F.desc("n"), "word").limit(words).collect()]


class Novelty:
    """Marginal compressed bytes of a candidate beside its surroundings."""

    def __init__(self, words: list[str]) -> None:
        # zstandard finds the end of its dictionary cheapest, so the commonest come last.
        content = " ".join(reversed(words)).encode()
        self._compressor = zstandard.ZstdCompressor(level=LEVEL)
        if len(content) >= 8:
            primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
            self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed)

    def __call__(self, text: str, start: int, end: int) -> float:
        around = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT] + "\n"
        without = around.encode("utf-8", "surrogatepass")
        candidate = text[start:end].encode()
        size = lambda data: len(self._compressor.compress(data))
        return (size(without + candidate) - size(without)) / len(candidate)


def find_secrets(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = NOVELTY
) -> DataFrame:
    """``id, spans`` for every row: ``spans`` is an array of ``start, end, kind, novelty``.

    Spans count code points, ends exclusive, ordered by start and kind. Base
    kinds always stay; ``novel`` spans are candidates whose novelty reaches
    ``threshold`` and that touch no base span. Null and empty texts have no
    spans; repeated rows each get theirs; an empty table gives an empty one.
    Candidates are compared with a bounded context, so long texts cost linear time.
    """
    words = identifiers(df, text_column)

    def build():
        novelty = Novelty(words)

        def work(part: dict[str, list]) -> Iterator[dict]:
            yield {
                id_column: part[id_column],
                "spans": [spans_of(text, novelty, threshold) for text in part[text_column]],
            }

        return work

    schema = (
        f"`{id_column}` {dict(df.dtypes)[id_column]}, "
        "spans array<struct<start: bigint, end: bigint, kind: string, novelty: double>>"
    )
    return map_slices(df, [id_column, text_column], build, schema, text_column)


def spans_of(text: str, novelty: Novelty, threshold: float) -> list[dict]:
    base = base_spans(text)
    measured = [(start, end, kind, novelty(text, start, end)) for start, end, kind in base]
    starts, furthest = sorted(start for start, *_ in base), []
    for _, end, _ in sorted(base):
        furthest.append(max(end, furthest[-1]) if furthest else end)
    for start, end in candidates(text):
        before = bisect_left(starts, end)
        if not (before and furthest[before - 1] > start):
            value = novelty(text, start, end)
            if value >= threshold:
                measured.append((start, end, "novel", value))
    measured.sort(key=lambda span: (span[0], KINDS.index(span[2])))
    return [dict(zip(("start", "end", "kind", "novelty"), span)) for span in measured]


def redact(df: DataFrame, text_column: str = "text", threshold: float = NOVELTY, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret in ``text_column`` replaced by ``mark``; all rows and columns stay.

    Null texts stay null. Overlapping spans are replaced together.
    """
    words = identifiers(df, text_column)
    columns = df.columns

    def build():
        novelty = Novelty(words)

        def work(part: dict[str, list]) -> Iterator[dict]:
            texts = []
            for text in part[text_column]:
                spans = spans_of(text, novelty, threshold)
                kept, at = [], 0
                for span in spans:
                    if span["start"] >= at:
                        kept += [text[at : span["start"]], mark]
                    at = max(at, span["end"])
                texts.append("".join([*kept, text[at:]]) if spans else text)
            yield {**part, text_column: texts}

        return work

    named = "__was_null"
    flagged = df.withColumn(named, F.col(text_column).isNull())
    schema = ", ".join(f"`{name}` {kind}" for name, kind in flagged.dtypes)
    done = map_slices(flagged, [*columns, named], build, schema, text_column)
    return done.withColumn(text_column, F.when(~F.col(named), F.col(text_column))).select(*columns)


def secret_report(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base spans, and all spans as text."""
    found = find_secrets(df, id_column, text_column)
    base = F.filter("spans", lambda span: span["kind"] != "novel")

    def listed(spans):
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        )

    def count(kind: str):
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        id_column,
        *(count(kind) for kind in KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
