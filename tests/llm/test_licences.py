import numpy as np
import pytest

from flowgauge.llm import licences
from flowgauge.llm.queries import op6_licence_scan

WORDS = b"licensed under the mit license apache version 2 0 cc by nc 4 released gnu general public x y".split()


def slow_places(words):
    out = []
    for phrase, label in licences.PHRASES.items():
        p = phrase.encode().split()
        out += [(label, i) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return sorted(out, key=lambda x: (x[1], x[0]))


def test_phrase_places_against_plain_search():
    scanner = licences.Scanner(licences.PHRASES, licences.NOTICES)
    rng = np.random.default_rng(3)
    loose = [b" ".join(rng.choice(WORDS, rng.integers(0, 80))) for _ in range(300)]
    # Parts of notices one after another: states that several phrases and notices share come up all the time.
    parts = [" ".join(w[a:b]).encode() for _, t in [*((0, p) for p in licences.PHRASES), *licences.NOTICES] if (w := t.split())
             for a in range(0, len(w), 3) for b in (a + 2, a + 4, a + 7, len(w))]
    dense = [b" ".join(rng.choice(parts, rng.integers(1, 8))) for _ in range(1500)]
    for text in [*loose, *dense]:
        n, places, _ = scanner.scan(text)
        assert n == len(text.split())
        assert sorted([(scanner.templates[k][1], at) for k, at in places], key=lambda x: (x[1], x[0])) == slow_places(text.split())


@pytest.mark.parametrize("text, found", [
    (b"this work is licensed under the gnu general public license version 3", []),
    (b"licensed under the apache license version 2 0", [("apache-2", 3)]),
    (b"released under the mit license", [("mit", 1)]),
])
def test_words_of_other_licences_are_no_phrase(text, found):
    scanner = licences.Scanner(licences.PHRASES, licences.NOTICES)
    assert [(scanner.templates[k][1], at) for k, at in scanner.scan(text)[1]] == found


def test_matching_statistics_against_all_substrings():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(1, 4, rng.integers(1, 12)).tolist() for _ in range(6)]
    automaton = licences.SuffixAutomaton(sequences)
    subs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = rng.integers(1, 5, 400).tolist()
    for i, (state, length) in enumerate(automaton.statistics(text)):
        longest = max((k for k in range(i + 2) if k == 0 or tuple(text[i + 1 - k:i + 1]) in subs))
        assert length == longest
        if length:
            ends = {(k, e) for k, s in enumerate(sequences) for e in range(len(s)) if s[e + 1 - length:e + 1] == text[i + 1 - length:i + 1] and e + 1 >= length}
            assert automaton.places[state] == ends


def test_spans_and_words(frame, awkward, nothing):
    notice = licences.NOTICES[1][1]
    broken = notice.replace(" of this software", " of THIS-fine software,")
    rows = {r.doc_id: r for r in licences.scan_licences(frame([
        (1, "Intro. Released under the MIT License."), (2, f"aa {broken} bb"), (3, "the the of of software"),
        (4, "CC-BY-NC cc by nc"), (5, "été x y"), (6, None)])).collect()}
    assert [(p.label, p.start, p.length) for p in rows[1].places] == [("mit", 2, 4)]
    assert any(s.label == "mit" and s.start == 1 and s.cover > 0.8 for s in rows[2].spans) and not rows[2].places
    assert not rows[3].spans and [p.start for p in rows[4].places] == [0, 3]
    assert rows[5].n_words == 2 and rows[6].n_words == 0
    assert licences.scan_licences(awkward).count() == 10 and licences.scan_licences(nothing).count() == 0


def test_repeated_notice_gives_disjoint_spans():
    scanner = licences.Scanner(licences.PHRASES, licences.NOTICES)
    _, places, spans = scanner.scan(b"licensed under cc by nc 4 0 . " * 50)
    whole = [s for s in spans if scanner.templates[s[0]][1] == "cc-by-nc" and s[3] == 7]
    assert len(places) == 50 and len(whole) == 50


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_columns(spark, folder):
    got = op6_licence_scan(spark, folder).collect()
    assert all(0 <= r.score <= 1 for r in got) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_base > 0) == (r.first_word is not None) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
