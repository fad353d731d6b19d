import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", text or "")].append(i)
    out = []
    for i, text in rows:
        content = re.sub(r"[\x20\x09-\x0d]+", " ", text or "")
        ids = [x for x in groups[content] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[content]), i == keep, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("salts", [1, 16])
@pytest.mark.parametrize("digest", ["sha256", "weak"])
def test_brute_force(awkward, frame, prose, salts, digest):
    """A digest that clashes for all texts still gives the same groups: contents are compared."""
    how = exact_dedup.sha256 if digest == "sha256" else (lambda c: F.lit("same"))
    docs = awkward.unionByName(frame([(100 + i, prose(30, i % 7) + " " * (i % 3)) for i in range(60)]))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exact_dedup.mark_copies(docs, salts=salts, digest=how).collect()
    want = expected(rows)
    assert sorted([tuple(r)[:4] for r in got], key=repr) == sorted([w[:4] for w in want], key=repr)
    if digest == "sha256":
        assert sorted([tuple(r) for r in got], key=repr) == want


def test_drop_keeps_columns_and_one_row_per_text(awkward):
    left = exact_dedup.drop_copies(awkward)
    assert left.columns == awkward.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 3, 4, 5, 6, 7, None], key=repr)


def test_empty(nothing):
    assert exact_dedup.mark_copies(nothing).count() == 0 and exact_dedup.drop_copies(nothing).count() == 0
