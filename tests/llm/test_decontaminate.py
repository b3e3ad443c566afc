import re

import pytest
from compare import compare, duck

from ledgerlake.llm.decontaminate import contamination, drop_contaminated
from ledgerlake.llm.queries import ORACLES, QUERIES


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=13):
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            v = words(item)
            n = min(width, len(v))
            for i in range(max(1, len(v) - width + 1) if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit.update(range(j, j + n))
                        if name is not None:
                            names.add(str(name))
        out.append((key, len(w), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i % 29}x{i}" for i in range(40))
ITEMS = [
    (1, LONG), (2, "Short item, four words"), (3, "single"), (4, None), (5, "..."), (None, "nameless words here"), (2, "another two"),
    (10, "the the the the the the the the the the the the the the the"), (11, "Straße ÉCOLE ÜBER"), (1, LONG),
]
DOCS = [
    (1, "intro " + LONG.upper() + " outro"), (2, " ".join(LONG.split()[5:18])), (3, " ".join(LONG.split()[5:17])), (4, None), (5, ""),
    (6, "a short ITEM four-words b single. SINGLE"), (7, "the " * 14), (8, "the " * 12), (9, "nameless; words (here)"),
    (1, "another two"), (1, "another two"), (None, "single"), (12, "straße École über"), (13, "straße ÉCOLE ÜBER"),
    (14, "x " * 200 + "single"), (15, ", ".join(LONG.split()[:30]) + " y" * 30 + " " + " ".join(LONG.split()[10:30])),
]


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}])
def test_matches_all_windows(spark, frame, options):
    got = contamination(frame(DOCS), frame(ITEMS, ("item_id", "text")), **options)
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got.collect()]
    assert sorted(rows, key=repr) == brute(DOCS, ITEMS)


def test_drop_keeps_columns_and_clean_rows(spark, frame):
    docs = frame(DOCS)
    kept = drop_contaminated(docs, frame(ITEMS, ("item_id", "text")))
    assert kept.columns == docs.columns
    want = sorted((k for (k, *_, bad) in brute(DOCS, ITEMS) if not bad), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_empty_tables(spark, frame):
    items, docs = frame(ITEMS, ("item_id", "text")), frame(DOCS)
    assert contamination(frame([]), items).count() == 0
    got = contamination(docs, frame([], ("item_id", "text"))).collect()
    assert len(got) == len(DOCS) and not any(r["contaminated"] or r["n_hit"] for r in got)


def test_query_matches_its_oracle_without_python(spark, sf):
    df = QUERIES["op6_decontamination"](spark, sf)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert compare(df, duck(sf), ORACLES["op6_decontamination"]) is None
