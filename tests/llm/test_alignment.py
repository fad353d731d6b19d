import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers

from flowgauge.llm import alignment
from flowgauge.llm.queries import op12_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(A, B)


def whole(tokenizers, text):
    """(A ids, B ids, links, groups) of a whole text, encoded in one piece; links byte range by byte range."""
    none = [], [], [], ""
    if not text:
        return none
    spaced = " " + text
    a, b = tokenizers.a.encode(spaced, add_special_tokens=False).ids, tokenizers.b.encode(text)
    la, lb = [tokenizers.bytes_a[i] for i in a], [tokenizers.bytes_b[i] for i in b]
    if b"".join(la) != spaced.encode() or b"".join(lb) != spaced.encode():
        return none
    owner_a = [i for i, t in enumerate(la) for _ in t]
    owner_b = [j for j, t in enumerate(lb) for _ in t]
    links = sorted(set(zip(owner_a, owner_b)))
    ends = set(np.cumsum(list(map(len, la))).tolist()) & set(np.cumsum(list(map(len, lb))).tolist())
    groups, start = [], 0
    for end in sorted(ends):
        ids = [sorted(set(owner[start:end])) for owner in (owner_a, owner_b)]
        groups.append(",".join(str(a[i]) for i in ids[0]) + "|" + ",".join(str(b[j]) for j in ids[1]))
        start = end
    return a, b, [(a[i], b[j]) for i, j in links], ";".join(groups)


def brute(tokenizers, rows):
    found = [(i, *whole(tokenizers, t)) for i, t in rows]
    counts = Counter(link for f in found for link in f[3])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(((i, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links),
                    sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "") for i, a, b, links, groups in found), key=str)


TEXTS = [
    "plain words, and more words.", " leading", "trailing ", "two  spaces   three", "tab\t x\n\n y \n z", "a  b  c", "naïve café 日本語 テスト",
    "x" * 700, "<|endoftext|> and <s> </s> <unk> <0x0A>", "nul \x00 inside", "▁ is a piece mark", "ﬁ ½ Ａ", "　wide　 space", "\x1c fs \x1c", "emoji 👩‍👩‍👧 x",
    "é é", "\r\n\r\n", " ", "\n", "", None, "don't we'll I'VE", "1234567890 12 345", "मानक हिन्दी", "Ω≈ç√∫˜µ", "_under__score_ --- ***",
]


def test_bytes_of_all_ids(tokenizers):
    assert tokenizers.cut and tokenizers.bytes_b[tokenizers.space] == b" "
    assert {len(t) for t in tokenizers.bytes_a[:256]} == {1} and len(set(tokenizers.bytes_a[:256])) == 256


def test_stretches_give_what_whole_texts_give(spark, tokenizers):
    rng = np.random.default_rng(6)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice([" ", "\n", "a", "b.", "é", " ", "'s", "日", "\t", "12"], 40)) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) < 4000").limit(300).collect() if r.text]
    texts += ["www.abc.de a.b i.e. e.g., x_y, (a)b ¿que? l'été «où» 5,000.25% C++/C#", "end.\nNext line\n\nthird\n (x)", "a\n\nb\n c", "a,\tb;\r\nc"]
    aligner = alignment.Aligner(A, B)
    found = aligner.align(texts)
    at = 0
    for i, text in enumerate(texts):
        a, b, links, groups = whole(tokenizers, text)
        assert found.groups[i] == groups
        assert (found.n_a[i], found.n_b[i], found.n_links[i]) == (len(a), len(b), len(links))
        mine = found.pairs[at:at + len(links)].tolist()
        assert sorted(mine) == sorted(j * tokenizers.size_a + i for i, j in links)
        at += len(links)


def test_merge_of_runs(monkeypatch):
    """Many runs of several blocks, pairs that go on over block ends, one pair that fills a run."""
    rng = np.random.default_rng(7)
    want, runs = Counter(), []
    for r in range(9):
        pairs = np.full(500, 17) if r == 4 else rng.integers(0, 60, int(rng.integers(1, 400)))
        keys = np.unique(pairs.astype(np.uint64) << np.uint64(32) | rng.integers(0, 1000, len(pairs)).astype(np.uint64))
        n = rng.integers(1, 5, len(keys))
        for k, v in zip((keys >> np.uint64(32)).tolist(), n.tolist()):
            want[k] += v
        runs.append(alignment.pack_run(keys, n, block=int(rng.integers(1, 90))))
    got = [(p, v) for pairs, n in alignment.merged_counts(runs) for p, v in zip(pairs.tolist(), n.tolist())]
    assert got == sorted(want.items())
    assert list(alignment.merged_counts([])) == []


@pytest.mark.parametrize("parts, buffer, cell", [(3, 50, 300), (16, 2_000_000, 32_000_000)])
def test_against_brute_force(spark, tokenizers, frame, parts, buffer, cell):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "the same words of all, " + str(i % 3)) for i in range(40)] + [(5, "again"), (None, "no id")]
    got = alignment.align_tokens(frame(rows).repartition(5), A, B, parts=parts, buffer=buffer, cell_bytes=cell).collect()
    assert sorted(map(tuple, got), key=str) == brute(tokenizers, rows)


def test_awkward_and_empty(spark, tokenizers, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = alignment.align_tokens(awkward, A, B, with_groups=True)
    assert sorted((tuple(r)[:-1] for r in got.collect()), key=str) == brute(tokenizers, rows)
    assert alignment.align_tokens(nothing, A, B).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, tokenizers, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op12_token_alignment(spark, folder).collect()), key=str) == brute(tokenizers, rows)
