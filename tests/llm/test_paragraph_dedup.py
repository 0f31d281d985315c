import random

import brute
import pytest

from pulseledger.llm import paragraph_dedup


def units(text):
    found = paragraph_dedup.units_of([text])
    return list(zip(found.number.tolist(), found.begin.tolist(), found.end.tolist(), found.n_words.tolist()))


def prose(rng, count):
    return [f"w{rng.randrange(3000)}" for _ in range(count)]


def test_clusters_equal_brute_force(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    every = [(doc, number, brute.shingles(text[begin:end])) for doc, text in rows for number, begin, end, _ in units(text or "")]
    groups = brute.Groups(range(len(every)))
    for n, (*_, one) in enumerate(every):
        for m in range(n):
            two = every[m][2]
            both = len(one & two)
            if both and 100 * both >= 75 * (len(one) + len(two) - both):
                groups.join(m, n)
    sizes: dict = {}
    for n in range(len(every)):
        sizes[groups.find(n)] = sizes.get(groups.find(n), 0) + 1
    expected = []
    for n, (doc, number, _) in enumerate(every):
        root = groups.find(n)
        if sizes[root] > 1:
            expected.append((doc, number, *every[root][:2], sizes[root], root != n))
    found = paragraph_dedup.repeated_paragraphs(docs).collect()
    got = [(r.doc_id, r.paragraph, r.kept_doc_id, r.kept_paragraph, r.n_copies, r.removed) for r in found]
    assert sorted(got) == sorted(expected) and got
    texts = dict(rows)
    assert all(len(texts[r.doc_id][r.begin : r.end].split()) == r.n_words for r in found)


def test_cutting_and_awkward_rows(spark, awkward, empty):
    passage = " ".join(f"word{n}" for n in range(60))
    df = spark.createDataFrame([(1, f"a\n{passage}\nb"), (2, f"{passage} more\nc"), (3, "d"), (4, None)], "doc_id long, text string")
    done = {r.doc_id: r.text for r in paragraph_dedup.remove_paragraphs(df).collect()}
    assert done == {1: f"a\n{passage}\nb", 2: "c", 3: "d", 4: None}
    found = paragraph_dedup.repeated_paragraphs(awkward).collect()
    # One phrase over and over is a copy of itself: of all its units one stays.
    assert [(r.doc_id, r.paragraph) for r in found if not r.removed] == [(3, 0)]
    assert {r.doc_id for r in found} == {3, 4}
    same = paragraph_dedup.remove_paragraphs(awkward)
    assert same.dtypes == awkward.dtypes and same.count() == awkward.count()
    assert paragraph_dedup.repeated_paragraphs(empty).collect() == []


def test_repeated_null_and_shared_ids_keep_what_is_theirs(spark):
    one, two, three = (" ".join(f"{kind}{n}" for n in range(30)) for kind in ("ab", "cd", "ef"))
    rows = [(1, f"{one}\n{two}"), (1, f"{one}\n{two}"), (1, f"{three}\nx"), (None, f"x\n{one}"), (None, f"{three} y\nz"), (2, "clean\nlines")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = paragraph_dedup.repeated_paragraphs(df).collect()
    assert "__row" not in found[0]
    # Each of the three passages stays once: two of them under the missing id, which comes first.
    stays = [r for r in found if not r.removed]
    assert {str(r.doc_id) for r in stays} == {"1", "None"}
    assert sum(r.n_words for r in stays if r.doc_id == 1) == 30 and sum(r.n_words for r in stays if r.doc_id is None) in (60, 61)
    kept = sorted(str(r.text) for r in paragraph_dedup.remove_paragraphs(df).collect())
    assert kept == sorted([two, "", "x", f"x\n{one}", f"{three} y\nz", "clean\nlines"])


@pytest.mark.parametrize("length", [50, 60, 100])
def test_passages_are_found_within_longer_lines_and_wrapped(spark, length):
    rng = random.Random(length)
    rows, count = [], 100
    for n in range(count):
        passage = prose(rng, length)
        line = " ".join(prose(rng, 80) + passage + prose(rng, 60))
        wrapped = "\n".join(" ".join(passage[at : at + 12]) for at in range(0, length, 12))
        rows += [(2 * n, line), (2 * n + 1, f"é {' '.join(prose(rng, 9))}\n{wrapped}\n{' '.join(prose(rng, 40))}")]
    rows += [(-n, " ".join(prose(rng, 200))) for n in range(1, 50)]
    texts = dict(rows)
    found = paragraph_dedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = {r.doc_id for r in found}
    assert len(hit) >= 0.9 * 2 * count and min(hit) >= 0
    for r in found:
        assert r.kept_doc_id // 2 == r.doc_id // 2 and r.removed == (r.doc_id % 2 == 1)
        assert len(texts[r.doc_id][r.begin : r.end].split()) == r.n_words


def test_units_cover_blocks_and_do_not_depend_on_the_neighbours():
    rng = random.Random(5)
    texts = ["", " ".join(prose(rng, 500)), "a b\nc", "日本 é\n" * 30, "\n".join(" ".join(prose(rng, n)) for n in (25, 3, 7, 12, 40, 2))]
    together = paragraph_dedup.units_of(texts)
    alone = [(n, *unit) for n, text in enumerate(texts) for unit in units(text)]
    got = list(zip(*(x.tolist() for x in (together.text, together.number, together.begin, together.end, together.n_words))))
    assert got == alone
    assert sum(r[4] for r in alone if r[0] == 1) == 500
    assert all(9 <= words <= 64 and len(texts[n][begin:end].split()) == words for n, _, begin, end, words in alone)
    # Lines of 25 and 40 words are blocks; the 22 words of the short lines between them are one; two words are none.
    assert sum(r[4] for r in alone if r[0] == 4) == 87
