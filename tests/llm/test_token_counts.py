import public_tokenizers
import sentencepiece

from pulseledger.llm import token_counts

TRICKY = ["", " ", "  a  b", "a\nb", "\n\n x", "a▁b", "x" * 90, "日本語 テスト 🎉", "<s>hi</s>", "a b", "1234567890 --- ====", "\u0000a"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))


def test_counts_are_the_librarys(docs, awkward):
    for frame in (docs, awkward):
        texts = [(row.doc_id, row.text or "") for row in frame.collect()]
        expected = sorted((str(key), len(text.encode()), len(library().encode(text))) for key, text in texts)
        found = token_counts.count_tokens(frame).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == expected
        assert all(r.over_limit == (r.n_tokens > 4096) for r in found)


def test_every_prefix_and_every_cut(docs):
    counter = token_counts.PrefixCounter(public_tokenizers.path(token_counts.MODEL))
    model = library()
    for text in TRICKY + [row.text[:150] for row in docs.limit(5).collect()]:
        expected = [len(model.encode(text[:n])) for n in range(len(text) + 1)]
        assert counter.table(text).tolist() == expected
        for budget in (0, 1, 3, 17):
            if text:
                longest = max(n for n, count in enumerate(expected) if count <= budget)
                assert counter.cut(*counter.chunks(text), budget) == longest


def test_prefix_tables_and_empty_table(awkward, empty):
    rows = token_counts.prefix_tables(awkward.where("doc_id in (1, 2, 5)")).collect()
    assert [r.prefix_tokens for r in rows if r.doc_id in (1, 2)] == [[0], [0]]
    assert token_counts.count_tokens(empty).collect() == []


def test_tables_give_the_counts_of_whole_texts(docs):
    counter = token_counts.PrefixCounter(public_tokenizers.path(token_counts.MODEL))
    texts = TRICKY + [row.text or "" for row in docs.collect()]
    found = [int(tokens[-1]) if parts else 0 for parts, tokens in counter.all_chunks(texts)]
    assert found == [len(ids) for ids in library().encode(texts)]
    assert counter.differing == 0


def test_long_text_without_blanks():
    counter = token_counts.PrefixCounter(public_tokenizers.path(token_counts.MODEL))
    text = "日本語テスト" * 5_000 + "abcdefg" * 5_000
    parts, tokens = counter.chunks(text)
    assert len(parts) == 1 and tokens[-1] == len(library().encode(text))
