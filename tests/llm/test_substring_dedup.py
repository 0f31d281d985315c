import random

import brute
import numpy as np

from pulseledger.llm import substring_dedup


def test_removed_bytes_equal_brute_force(spark, docs):
    draw = random.Random(5)
    base = docs.select("doc_id", "text").limit(80)
    texts = [r.text for r in base.collect() if len(r.text) > 700]
    rows = [(None, "x" * 900), (-1, "ab" * 500), (-2, ""), (-3, None), (-4, "é" * 450), (-4, "é" * 450)]
    for n in range(60):
        text = draw.choice(texts)
        start = draw.randrange(len(text) - 650)
        size = draw.choice([380, 398, 399, 400, 401, 405, 450, 640])
        rows.append((10**6 + n, f"{n} " * draw.randint(1, 50) + text[start : start + size] + f" end{n}"))
    frame = base.unionByName(spark.createDataFrame(rows, base.schema))
    found = substring_dedup.remove_repeats(frame).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute.remove_repeats([tuple(r) for r in frame.collect()], 400)


def test_interval_expansion_marks_common_prefixes():
    draw = np.random.default_rng(7)
    for _ in range(30):
        symbols = np.append(draw.integers(1, 3, 60), 0)
        order, parted = substring_dedup.parted_before(symbols, 4)
        suffixes = [symbols[n:].tolist() for n in range(len(symbols))]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda n: suffixes[n])
        for place in range(1, len(order)):
            one, two = suffixes[order[place - 1]][:4], suffixes[order[place]][:4]
            assert parted[place] == (one != two)


def test_awkward_rows(awkward, empty):
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(awkward).collect()}
    assert found[2].n_bytes == 0 and found[1].n_spans == 0
    assert found[3].n_removed == found[3].n_bytes and found[3].n_spans == 1
    assert substring_dedup.remove_repeats(empty).collect() == []


def windows_of(found):
    """Key and offset of every window, by text and start."""
    return {
        (text, first + n): (key, offset - n)
        for text, first, count, offset, key in zip(*(found[name].tolist() for name in ("text", "first", "windows", "offset", "key")))
        for n in range(count)
    }


def test_pieces_give_every_window_its_key():
    draw = np.random.default_rng(9)
    texts = [draw.integers(97, 105, size, dtype=np.uint8).tobytes() for size in (0, 399, 400, 5000, 1001, 401, 12000)]
    whole = windows_of(substring_dedup.segments(texts, 400))
    assert set(whole) == {(n, start) for n, text in enumerate(texts) for start in range(len(text) - 399)}
    for piece in (1, 150, 602, 5000):
        few = texts[:3] if piece == 1 else texts
        assert windows_of(substring_dedup.segments(few, 400, piece)) == {at: v for at, v in whole.items() if at[0] < len(few)}


def test_windows_beyond_sixteen_mebibytes():
    draw = np.random.default_rng(11)
    passage = draw.integers(32, 127, 700, dtype=np.uint8).tobytes()
    filler = draw.integers(32, 127, (1 << 24) + 3000, dtype=np.uint8).tobytes()
    found = substring_dedup.segments([passage + filler + passage], 400)
    assert found["offset"].min() >= 0 and found["windows"].sum() == len(filler) + 1400 - 399
    ends = (found["first"] + found["windows"] <= 301, found["first"] >= len(filler) + 700)
    near, far = (windows_of({name: values[end] for name, values in found.items()}) for end in ends)
    assert len(near) > 150
    assert all(far[0, start + len(filler) + 700] == v for (_, start), v in near.items() if (0, start + len(filler) + 700) in far)
    assert len(far) > 150
