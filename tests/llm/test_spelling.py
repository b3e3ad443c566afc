import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import compare, duck
from ledgerlake.llm import spelling
from ledgerlake.llm.queries import ORACLES, QUERIES

WORDS = st.text("abcé", min_size=7, max_size=14)


def edited(word, rng):
    at = rng.randrange(len(word) + 1)
    kind = rng.choice("idr")
    letter = rng.choice("abcé")
    return word[:at] + {"i": letter + word[at:], "d": word[at + 1 :], "r": letter + word[at + 1 :]}[kind]


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs, least_length=7, least_count=2, times=10):
    import re

    seen = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= least_length and n >= least_count}
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_apart(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= times * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def made(seed, n=120, parts="th er on ción é Ñ ung st a"):
    rng = random.Random(seed)
    syllables = parts.split()
    base = ["".join(rng.choice(syllables) for _ in range(rng.randint(3, 8))) for _ in range(40)]
    docs = []
    for i in range(n):
        words = rng.choices(base, [2.0 ** -(j / 3) for j in range(len(base))], k=200)
        words = [edited(w, rng) if rng.random() < 0.1 else w for w in words]
        docs.append((i, " ".join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return docs


@pytest.mark.parametrize("long", [spelling.LONG, 3])
def test_variants_against_all_pairs(spark, frame, long):
    docs = made(5)
    # a chain of three
    docs += [(1000, "abcdefgh " * 500), (1001, "abcdefgi " * 40), (1002, "abcdexgi " * 3)]
    rows = got(spelling.variants(frame(docs), long=long))
    assert rows == expected(docs)
    assert any(r[1] for r in rows) and any(r[2] != r[0] and r[2] != r[1] for r in rows)


def test_odd_rows(spark, frame):
    docs = [(1, None), (2, ""), (None, "notebook notebook"), (3, "12 --"), (3, "notebook, Notebook×notebook"), (3, "notebook, Notebook×notebook")]
    docs.append((4, "longword" * 4000 + " " + "short " * 50_000 + "notebooks " * 2))
    assert got(spelling.variants(frame(docs))) == expected(docs)
    assert got(spelling.variants(frame([]))) == []
    with pytest.raises(ValueError):
        spelling.variants(frame(docs), least_length=5)


@settings(max_examples=200, deadline=None)
@given(WORDS, st.randoms(use_true_random=False), st.integers(0, 9))
def test_near_words_share_a_chosen_gram(word, rng, limit):
    """The bound itself, for any counts of grams."""
    other = edited(word, rng)
    if len(other) < 7 or not one_apart(word, other):
        return
    counts = np.random.default_rng(limit).integers(0, 10, 1 << spelling.CLASS_BITS)
    known = spelling.Dictionary(counts, limit, spelling.SHORTEST, spelling.LONGEST)
    a, b = sorted((word, other), key=lambda w: (len(w), w))

    def lists(w):
        owner, gram, place = spelling.listed(spelling.Grams(pa.array([w])), known)
        return set(zip(gram.tolist(), place.tolist()))

    steps = (0, 1) if len(a) < len(b) else (0,)
    assert any((g, p + step) in lists(b) for g, p in lists(a) for step in steps)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms, 4).collect()} == {"w9"}


def test_query_against_sql(spark, sf):
    assert compare(QUERIES["op13_spelling_variants"](spark, sf), duck(sf), ORACLES["op13_spelling_variants"]) is None
