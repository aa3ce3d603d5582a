import struct
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm.sequence_packing import Encoder, Packer, best_fill, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_best_fill_is_the_best_subset_sum(counts, room):
    reach = {0}
    for length, n in counts.items():
        reach = {s + length * k for s in reach for k in range(n + 1)}
    used = best_fill(counts, room)
    assert all(used[k] <= counts[k] for k in used)
    assert sum(k * n for k, n in used.items()) == max(s for s in reach if s <= room)


def test_all_sequences_are_full_or_powers_of_two():
    packer = Packer(64)
    for i in range(100):
        packer.put(i, 0, i % 63 + 1)
    lengths = [sum(p[2] for p in s) for s in packer.rest()]
    assert sum(lengths) == sum(i % 63 + 1 for i in range(100))
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths)


ODD = ["", "a<|endoftext|>b", "It's they'll ÀÉÎ ß ÿ µ º ² ½x 10th \xad soft", "İstanbul Σς", "é x", "a\x0bb\x1cc\x85d\xa0e", "''s 'sx don't-stop...!!"]


def test_encoder_equals_the_library():
    library = Tokenizer.from_file(PATH)
    encoder = Encoder(PATH)
    for _ in range(2):
        for text, ids in zip(ODD, encoder.encode(ODD), strict=True):
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode(text, add_special_tokens=False).ids


def test_pieces_tile_documents_and_sequences(spark):
    texts = [None, "", *ODD, "word salad " * 9000, "same text", "same text", None]
    rows = [(i if i else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, offset int")
    library = Tokenizer.from_file(PATH)
    got = pack(docs, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert len(by_doc) == len(texts)
    for i, _, *_ in rows:
        want = library.encode(texts[i or 0] or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert b"".join(bytes(p.ids) for p in pieces) == struct.pack(f"<{len(want)}I", *want)
        assert {p.doc_tokens for p in pieces} == {len(want)}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        n = sum(p.length for p in pieces)
        assert n == 4096 or n & (n - 1) == 0
    assert pack(docs.limit(0), PATH).count() == 0
