import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import pieces as k
from ledgerlake.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def vocab():
    return k.load(PIECE_MODEL)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


TEXTS = [
    "", "a", "  a  b ", "a\tb\n\nc  ", "ＡＢ 漢字漢字\n", "x" * 200, "ab" * 3000, "the theory of the thing", "    indent   " * 3,
    "é<0x0A>", "naïve café – “quoted” 🙂🙂", "Thston with thhawhble st, thwhrest", "   x",
]


def test_without_dropout_equals_the_library(vocab):
    import sentencepiece

    ref = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL).encode(TEXTS)
    assert split(*k.encode(vocab, TEXTS, [b""] * len(TEXTS))) == ref


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5), st.floats(0, 1))
def test_decoding_gives_the_text_back(texts, dropout):
    vocab = k.load(PIECE_MODEL) if not hasattr(test_decoding_gives_the_text_back, "v") else test_decoding_gives_the_text_back.v
    test_decoding_gives_the_text_back.v = vocab
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["▁x ▁", "\x00"]
    got = split(*k.encode(vocab, texts, [str(i).encode() for i in range(len(texts))], dropout, 5))
    assert [k.decode(vocab, ids).decode() for ids in got] == texts


def test_long_and_short_ways_agree(vocab):
    rng = random.Random(1)
    units = [" " + "".join(rng.choice("theanrsingo") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    points = [[vocab.char_id[ord(c)] for c in u] for u in units]
    hashed = k.mix64(np.arange(len(units), dtype=np.uint64))
    owner = np.repeat(np.arange(len(units)), [len(p) for p in points])
    for dropout in (0.0, 0.1, 0.5):
        ids, own = k.segment(vocab, np.array(sum(points, [])), owner, hashed, dropout)
        for i, p in enumerate(points):
            assert ids[own == i].tolist() == k.segment_long(vocab, list(p), hashed[i], dropout)


def test_dropout_varies_and_repeats(vocab):
    text = "the theory of the thing that they think through " * 20
    plain, _ = k.encode(vocab, [text], [b"1"])
    one, _ = k.encode(vocab, [text], [b"1"], 0.3, 7)
    assert one.tolist() == k.encode(vocab, [text], [b"1"], 0.3, 7)[0].tolist()
    assert len(one) > len(plain)
    assert one.tolist() != k.encode(vocab, [text], [b"2"], 0.3, 7)[0].tolist()
    assert one.tolist() != k.encode(vocab, [text], [b"1"], 0.3, 8)[0].tolist()
    assert all(len(vocab.strings[i].decode("utf-8", "ignore")) <= 1 for i in k.encode(vocab, [text], [b"1"], 1.0, 7)[0])


def test_each_occurrence_draws_its_own_skips(vocab):
    n = 20_000
    rows = split(*k.encode(vocab, ["to"] * n, [str(i).encode() for i in range(n)], 0.1, 7))
    plain = split(*k.encode(vocab, ["to"], [b""]))[0]
    ways = {tuple(r) for r in rows}
    assert len(plain) == 1 and len(ways) > 2
    seen = []
    k._encode_units(vocab, [" to"], np.zeros(1, np.uint64), 0.0, seen)
    assert sum(len(x[0]) for x in seen) >= 3
    text = " ".join(["internationalization"] * 3000)
    ids = k.encode(vocab, [text], [b"1"], 0.1, 7)[0].tolist()
    assert k.decode(vocab, ids).decode() == text
    words = {tuple(r) for r in split(*k.encode(vocab, ["internationalization"] * 3000, [str(i).encode() for i in range(3000)], 0.1, 7))}
    assert len(words) > 8


def test_shared_segmentations_equal_own_ones(vocab):
    rng = random.Random(4)
    words = ["the", "theory", "thinking", "a", "of", "internationalization", "x" * 60, "漢字"]
    names = [" " + w for w in words]
    unit = np.array([rng.randrange(len(words)) for _ in range(3000)])
    hashed = k.mix64(np.arange(3000, dtype=np.uint64))
    for dropout in (0.1, 0.5, 1.0):
        flat, sizes, made = k._with_dropout(vocab, names, unit, hashed, dropout)
        got = split(flat, sizes)
        own = split(*k._encode_units(vocab, [names[u] for u in unit], hashed, dropout))
        assert [got[m] for m in made] == own


def test_table(spark, frame, vocab):
    docs = frame([(1, "ab cd"), (None, None), (2, ""), (1, "ab cd"), (3, "word " * 5000)])
    rows = k.add_ids(docs, vocab, out="token_ids").collect()
    assert len(rows) == 5 and all(r["lossless"] for r in rows)
    for r in rows:
        assert k.decode(vocab, r["token_ids"]).decode() == (r["text"] or "")
    assert rows[0]["token_ids"] == rows[3]["token_ids"] and rows[1]["token_ids"] == []
    assert k.add_ids(frame([]), vocab).count() == 0


def test_skips_that_change_no_merge_do_not_part_occurrences(vocab):
    """A candidate whose symbol went into a better one first is never merged, so skipping it makes no other segmentation."""
    n = 4000
    hashed = k.mix64(np.arange(n, dtype=np.uint64))
    for word, most in ((" the", 60), (" government", 1000)):
        flat, sizes, made = k._with_dropout(vocab, [word], np.zeros(n, np.int64), hashed, 0.1)
        assert len(sizes) <= most and len(made) == n
        assert len({tuple(x) for x in split(flat, sizes)}) > 2
    once = k._with_dropout(vocab, [f" {i}x" for i in range(500)], np.arange(500), hashed[:500], 0.1)[1]
    assert len(once) == 500  # a unit that comes once is segmented once


def test_units_of_all_lengths_together_and_alone(vocab):
    """Units of every length up to the longest of a table, alone and among others."""
    units = [" " + ("antidisestablishmentarianism" * 2)[:m] for m in range(k.LONG + 3)] + ["é漢" * m for m in range(1, 24)]
    hashed = k.mix64(np.arange(len(units), dtype=np.uint64))
    for dropout in (0.0, 0.2, 0.9):
        together = split(*k._encode_units(vocab, units, hashed, dropout))
        alone = [k._encode_units(vocab, [u], hashed[i : i + 1], dropout)[0].tolist() for i, u in enumerate(units)]
        assert together == alone
