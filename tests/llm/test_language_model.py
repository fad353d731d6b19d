import math
from collections import Counter, defaultdict

import pytest

from flowgauge.llm import language_model as lm


class Slow:
    """The same model from plain dictionaries."""

    def __init__(self, texts):
        docs = [(t or "").encode().lower().split() + [b"\n"] for t in texts]
        self.count = Counter(w for d in docs for w in d)
        self.pairs = Counter(p for d in docs for p in zip([None, *d], d, strict=False))
        self.uses, self.kinds, self.after = Counter(), defaultdict(lambda: [0, 0, 0, 0]), Counter()
        for (a, b), n in self.pairs.items():
            self.uses[a] += n
            self.kinds[a][min(n, 3)] += 1
            self.after[b] += 1
        of, ofw = Counter(self.pairs.values()), Counter(self.after.values())
        self.d, self.e = lm.discounts(*(of[k] for k in (1, 2, 3, 4))), lm.discounts(*(ofw[k] for k in (1, 2, 3, 4)))

    def word(self, w):
        if not self.pairs:
            return 1.0
        left = sum(self.e[min(n, 3)] for n in self.after.values())
        return (self.after[w] - self.e[min(self.after[w], 3)] + left / (len(self.count) + 1)) / len(self.pairs)

    def pair(self, a, b):
        if not self.uses[a]:
            return self.word(b)
        n, kinds = self.pairs[a, b], self.kinds[a]
        return (n - self.d[min(n, 3)] + sum(self.d[k] * kinds[k] for k in (1, 2, 3)) * self.word(b)) / self.uses[a]

    def score(self, text):
        words = (text or "").encode().lower().split() + [b"\n"]
        total, kinds = sum(self.count.values()), len(self.count)
        base = sum(math.log10((self.count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        return (len(words), sum(self.count[w] > 0 for w in words), total, base,
                sum(math.log10(self.pair(a, b)) for a, b in zip([None, *words], words, strict=False)))


@pytest.mark.parametrize("hot", [False, True])
def test_against_dictionaries(spark, awkward, frame, prose, hot, monkeypatch):
    """Also with small caches and flushes; ``hot``: one word is a third of all tokens and spread over all ranges."""
    monkeypatch.setattr(lm, "CACHED_WORDS", 100)
    train = frame([(i, prose(200, i % 5) + " Foo BAR foo " * (i % 3) + (" the" * 150 if hot else "")) for i in range(40)] + [(99, None)])
    model = lm.train(train)
    if hot:
        model.ranges.hot = min(model.ranges.hot, 1000)
        assert model.words.tokens // 3 < sum(t.text.split().count("the") for t in train.collect() if t.text) + model.words.tokens // 20
    slow = Slow([r.text for r in train.collect()])
    unseen = awkward.unionByName(frame([(300, "the the unknownword ta re"), (301, "Foo bar zz")])).unionByName(train)
    got = sorted(map(tuple, lm.score(unseen, model).collect()), key=repr)
    want = sorted([(r.doc_id, *slow.score(r.text)) for r in unseen.collect()], key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], abs=1e-6) and g[5] == pytest.approx(w[5], rel=1e-9)
    for context in (b"foo", b"nothere", b"the", None):
        assert sum(slow.pair(context, w) for w in slow.count) + slow.pair(context, b"?") == pytest.approx(1)


def test_more_ranges_than_words(spark, frame):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        train = frame([(1, "a b a c"), (2, "a a b")])
        slow = Slow(["a b a c", "a a b"])
        got = {r.doc_id: r.score for r in lm.score(frame([(5, "b a b z"), (6, None), (7, "c c a b")]), lm.train(train)).collect()}
        assert got == pytest.approx({5: slow.score("b a b z")[4], 6: slow.score("")[4], 7: slow.score("c c a b")[4]})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nothing_to_learn(nothing, awkward):
    model = lm.train(nothing)
    got = lm.score(awkward, model).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score <= 0 and r.score > -1e9 for r in got) and len(got) == 10
    assert lm.score(nothing, model).count() == 0


def test_learns_more_than_single_words(spark):
    from flowgauge.llm.queries import op2_lm_scores

    got = op2_lm_scores(spark, "/root/testdata/sf0.001").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() and 0 < len(held) < len(got)
