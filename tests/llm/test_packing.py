import zlib
from collections import defaultdict

import numpy as np
import pytest

from flowgauge.llm import packing

vocabulary = pytest.importorskip("public_tokenizers")


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary.path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("longest", [8, 4096])
def test_pieces_rebuild_every_document(awkward, frame, longest):
    docs = awkward.filter("doc_id IS NULL OR doc_id != 4 OR %d > 8" % longest).unionByName(frame(
        [(50, "It's A. b!! <|endoftext|>. <|ENDOFTEXT|>, 'S x.y 9. É, ΑΣ.")]))
    rows = packing.pack(docs, vocabulary.path("word_bpe_49k.json"), longest=longest, with_ids=True).collect()
    of = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) <= longest and r.length & (r.length - 1) == 0 and r.offset == 0 and 1 << r.bucket == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        of[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    assert len({r.sequence_id for r in rows}) == len(rows)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    assert set(texts) == set(of)
    for i, group in texts.items():
        want = ids_of(group[0])
        pieces = sorted(of[i], key=lambda p: p[0])[::len(group)]
        assert sum((p[1] for p in pieces), []) == want and all(p[2] == len(want) for p in pieces)
        assert len(of[i]) == len(group) * len(packing.binary_pieces(len(want), longest))


def test_cache_may_be_emptied(prose, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    words = packing.WordIds(vocabulary.path("word_bpe_49k.json"))
    texts = [prose(30, s) for s in range(5)]
    for _ in range(2):
        assert [list(x) for x in words.encode([t.encode() for t in texts], 2)] == [ids_of(t) for t in texts]


def test_binary_pieces():
    assert packing.binary_pieces(4096 * 2 + 5) == [4096, 4096, 4, 1] and packing.binary_pieces(1) == [1]


def test_empty_and_buckets(nothing, frame, tmp_path, spark):
    path = vocabulary.path("word_bpe_49k.json")
    assert packing.pack(nothing, path).count() == 0
    packing.write_buckets(packing.pack(frame([(1, "a b c"), (2, "d")]), path), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("length_bucket != bucket").count() == 0 and back.agg({"length": "sum"}).first()[0] == 6


def test_new_words_are_tokenized_without_offsets():
    """Words are learned by the tokenizer's shorter way, which leaves out the offsets; the ids are those of the full one."""
    words = packing.WordIds(vocabulary.path("word_bpe_49k.json"))
    full = words.tokenizer

    class IdsAlone:
        encode_batch_fast = staticmethod(full.encode_batch_fast)

    words.tokenizer = IdsAlone()
    text = "Some words, and one <|end|> été 12.5 again; words!"
    assert words.encode([text.encode()], 2)[0].tolist() == [*full.encode(text, add_special_tokens=False).ids, 2]
