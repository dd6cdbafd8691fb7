"""Packing and byte-level BPE, against the libraries that own the vocabularies."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from augury.llm.byte_bpe import ByteBpe, decode_ids, encode_and_decode, read_ranks
from augury.llm.packing import WordTokenizer, best_two_fit, pack

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = " \n\t\x1c\x85 AB'SsTtLl1²é漢字😀Σ.,-ßÀ×´΅é  "


def nonsense(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 16))) for _ in range(n)]


def test_word_ids_are_the_tokenizers(documents):
    own, theirs = WordTokenizer(WORDS, remember=50), Tokenizer.from_file(WORDS)
    texts = [r["text"] for r in documents.select("text").limit(60).collect()] + nonsense(3000)
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_a_word_that_comes_back_is_tokenized_once(monkeypatch):
    asked, part = [], WordTokenizer._part
    monkeypatch.setattr(WordTokenizer, "_part", lambda self, own: asked.append(own) or part(self, own))
    own = WordTokenizer(WORDS, remember=20)
    for k in range(100):
        own.encode(f"often {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}")
    assert asked.count("often") == 1 and len(asked) > 100
    assert max(len(own.known), len(own.parts)) <= 20


def test_bpe_ids_are_tiktokens(documents):
    own = ByteBpe(RANKS, public_tokenizers.PATTERN, remember=50)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    texts = [r["text"] for r in documents.select("text").limit(60).collect()] + nonsense(3000)
    for text in texts:
        coded = own.encode(text)
        assert np.frombuffer(coded, "<u4").tolist() == theirs.encode_ordinary(text)
        assert own.decode(coded) == text.encode()


def test_encode_and_decode_rows(odd, nothing):
    coded = encode_and_decode(odd, RANKS, public_tokenizers.PATTERN, with_ids=True)
    back = decode_ids(coded, RANKS).collect()
    assert len(back) == odd.count()
    texts = sorted((r["text"] or "").encode() for r in odd.select("text").collect())
    assert sorted(bytes(r["decoded"]) for r in back) == texts
    assert all(r["n_tokens"] == len(r["ids"]) for r in back)
    assert encode_and_decode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing(documents, odd, nothing):
    theirs = Tokenizer.from_file(WORDS)
    for table in (documents, odd):
        rows = pack(table, WORDS).collect()
        expected = []
        for d in table.select("doc_id", "text").collect():
            ids = np.array(theirs.encode(d["text"] or "", add_special_tokens=False).ids + [0], "<u4")
            for piece, at in enumerate(range(0, len(ids), 2048)):
                part = ids[at : at + 2048]
                expected.append((d["doc_id"] or -1, piece, at, len(part), zlib.crc32(part.tobytes())))
        assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
        used = check_packing(rows, 2048)
        assert used <= 1.02 * -(-sum(e[3] for e in expected) // 2048) + 1
    assert pack(nothing, WORDS).count() == 0


def one_by_one(lengths, capacity):
    """The same filling rule, a sequence at a time."""
    from augury.llm.packing import _fill

    count = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        count[length] = n
    bins = []
    while count.any():
        bins.append(sorted(_fill(count, capacity)))
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_sequences_equal_one_at_a_time(seed):
    r = random.Random(seed)
    lengths = {n: r.randint(1, 30) for n in r.sample(range(1, 101), 25)}
    plan, total = best_two_fit(lengths, 100)
    bins = {}
    for length, n in lengths.items():
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            bins.setdefault(s, []).append((o, length))
    assert len(bins) == total
    for places in bins.values():
        assert [o for o, _ in sorted(places)] == np.cumsum([0, *[n for _, n in sorted(places)]])[:-1].tolist()
    assert sorted(sorted(n for _, n in p) for p in bins.values()) == one_by_one(lengths, 100)


def test_two_documents_replace_the_smallest():
    # Greedy takes 60 and 30 and leaves 10; 20 and 20 for the 30 fill it.
    plan, total = best_two_fit({60: 1, 30: 1, 20: 2}, 100)
    assert total == 2
    sequence, _ = plan.place(np.array([60, 20, 20]), np.array([0, 0, 1]))
    assert len(set(sequence.tolist())) == 1


def test_a_worker_keeps_one_operators_memory():
    from augury.llm import ngram_join, radix_dedup, shared, toxicity
    from augury.llm.packing import _tokenizer

    def left(work):
        own = _tokenizer(WORDS)
        assert _tokenizer(WORDS) is own and own in shared._KEPT.values()
        list(work)
        return own in shared._KEPT.values()

    assert not left(toxicity._term_counts(iter([])))
    assert not left(radix_dedup._heads(iter([])))
    own = _tokenizer(WORDS)
    shared.kept("other", list)
    assert own not in shared._KEPT.values() and len(shared._KEPT) == 1
    shared.forget()
    assert not shared._KEPT and ngram_join.forget is shared.forget
