"""Packing: token ids against the tokenizer, validity, optimality on small cases."""

import itertools
import random
import struct
from collections import Counter, defaultdict
from zlib import crc32

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sentinela.llm.packing import best_fit, lower_bound, pack_documents, pack_lengths, search_lengths, sequences
from sentinela.llm.tokens import TokenBytes

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "Hello, World's don't I'LL 's 't''re", "É́ é ﬁ ΑΣ ΣΑΣ İ ıI K", "a<|endoftext|>b <|startoftext|> <|STARTOFTEXT|>",
    "tabs\tand\x0bvt nb\u0085x y", "漢字 👍🏽 x² ½ Ⅷ ９ １２ ١٢", "x­soft ß ẞ Ǆ ŉ", "\n\n a \n", "a\x00b \x1c c\x1fd", "%%% the&&& x$$$ a., ...",
]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_the_tokenizers(text):
    assert _ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


TOKENIZER, BYTES = Tokenizer.from_file(PATH), TokenBytes(PATH)


def _ids(text):
    data = BYTES.ids(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_ids_of_odd_texts_and_other_tokenizers():
    assert BYTES.by_word
    for t in ODD:
        assert _ids(t) == TOKENIZER.encode(t, add_special_tokens=False).ids
    other = public_tokenizers.path("byte_bpe_50k.json")
    one, whole = TokenBytes(other), Tokenizer.from_file(other)
    assert not one.by_word
    for t in ODD:
        assert list(struct.unpack(f"<{len(one.ids(t)) // 4}I", one.ids(t))) == whole.encode(t, add_special_tokens=False).ids


def _fewest(pieces, capacity):
    """Exhaustive: the fewest sequences by trying all assignments (small cases)."""
    best = len(pieces)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best and i < len(pieces):
            if len(rooms) > best:
                return
        if i == len(pieces):
            best = min(best, len(rooms))
            return
        for r in sorted(set(rooms)):
            if r >= pieces[i]:
                rest = list(rooms)
                rest.remove(r)
                put(i + 1, [*rest, r - pieces[i]])
        if len(rooms) + 1 < best:
            put(i + 1, [*rooms, capacity - pieces[i]])

    put(0, [])
    return best


def _check(counts, capacity, fillings):
    used = Counter()
    for filling, times in fillings:
        assert times > 0 and sum(n * c for n, c in filling) <= capacity
        for n, c in filling:
            used[n] += c * times
    assert +used == +Counter(counts)
    return sum(t for _, t in fillings)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_small_packings_are_optimal(pieces):
    counts = dict(Counter(pieces))
    got = _check(counts, 12, pack_lengths(counts, 12, width=50))
    want = _fewest(sorted(pieces, reverse=True), 12) if pieces else 0
    assert lower_bound(counts, 12) <= want if pieces else True
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([20, 50, 100]), st.lists(st.integers(1, 100), max_size=13))
def test_default_search_is_optimal_or_says_so(capacity, pieces):
    pieces = [min(n, capacity) for n in pieces]
    fillings, proven = search_lengths(Counter(pieces), capacity)
    got = _check(Counter(pieces), capacity, fillings)
    want = _fewest(sorted(pieces, reverse=True), capacity) if pieces else 0
    assert got == want if proven else got >= want


def test_search_uses_copies_left_and_triples():
    pieces = [10, 12, 13, 16, 17, 21, 25, 31]
    fillings, proven = search_lengths(Counter(pieces), 50)
    assert _check(Counter(pieces), 50, fillings) == 3 and proven
    assert search_lengths(Counter(random.Random(5).choices(range(600, 1100), k=400)), 2048, steps=3)[1] is False


def test_search_beats_best_fit_and_meets_the_bound():
    counts = Counter(random.Random(1).choices(range(300, 900), k=300))
    plain = _check(counts, 2048, best_fit(counts, 2048))
    assert _check(counts, 2048, pack_lengths(counts, 2048)) < plain
    counts = {1024: 10**9, 2048: 5, 1: 3}
    assert _check(counts, 2048, pack_lengths(counts, 2048)) == 5 * 10**8 + 6
    with pytest.raises(ValueError):
        pack_lengths({2049: 1}, 2048)


def test_documents(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["the", "Cat", "sat.", "é", "x9"]) for _ in range(rng.randint(0, 150)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "the " * 3000), (None, "no id"), (7, "twice"), (7, "twice")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS piece", "'s' AS sequence_id")
    placed = pack_documents(spark, df, PATH, capacity=128, with_ids=True)
    rows = placed.collect()
    want = Counter()
    for d, t in docs:
        ids = [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), 128)):
            part = ids[a : a + 128]
            want[d, p, a, len(part), crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 128
    assert len(by) <= -(-sum(r.length for r in rows) // 128) + 1
    whole = {r.sequence_id: r for r in sequences(placed).collect()}
    assert sum(len(r.ids) for r in whole.values()) == sum(r.length for r in rows)
    assert all(len(r.ids) <= 128 for r in whole.values())
    assert pack_documents(spark, df.limit(0), PATH).count() == 0
