"""Packing and piece coding."""

import bisect
import hashlib
import random
import zlib
from array import array

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from quadrille.llm.best_fit import best_fit_plan, pack_documents, encoder
from quadrille.llm.piece_merge import PieceCodec, decode, digests, encode
from quadrille.llm.queries import BYTE_BPE, PIECES
from tokenizers import Tokenizer

ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "a▁b ▁ c", "日本語 テスト", "😀x\x00y", "\t tab", "a" * 3000, "é̂ ﬁ ²2²a",
       "trail   \n \n", "<s> </s> <unk> <0x0A>", "<|endoftext|> it's I'LL", "　wide", "a\r\nb", "can't  1234 ?!", "***a*** ###"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80), st.just(30))
def test_plan_is_best_fit_decreasing(sizes, capacity):
    counts = {s: sizes.count(s) for s in sizes}
    plan, used = best_fit_plan(counts, capacity), {}
    for size, a, b, first, each, offset in plan:
        for r in range(a, b):
            used.setdefault(first + (r - a) // each, []).append((offset + (r - a) % each * size, size))
    assert sum(map(len, used.values())) == len(sizes)
    for places in used.values():
        end = 0
        for at, size in sorted(places):
            assert at == end
            end += size
        assert end <= capacity
    # document after document gives as many bins
    left, bins = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(left, s)
        if i < len(left):
            rest = left.pop(i) - s
        else:
            bins, rest = bins + 1, capacity - s
        bisect.insort(left, rest)
    assert len(used) == bins


def test_packing(docs):
    r = random.Random(5)
    texts = [*ODD, "word " * 9000, "x y " * 1023 + "x y"] + [" ".join(f"w{r.randint(0, 999)}" for _ in range(r.randint(1, 900))) for _ in range(60)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    got, used, by = pack_documents(docs(texts), BYTE_BPE, with_ids=True).collect(), {}, {}
    for p in got:
        assert p.ids == ids[p.doc_id][p.start : p.start + p.length] and p.length <= 2048
        assert p.ids_crc32 == zlib.crc32(array("I", p.ids).tobytes())
        assert p.piece == 0 or p.length == 2048 or len(ids[p.doc_id]) <= 2048
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by.setdefault(p.doc_id, []).append(p.length)
    assert {i: sum(v) for i, v in by.items()} == {i: len(v) for i, v in enumerate(ids)}
    for places in used.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 2048
    assert pack_documents(docs([]), BYTE_BPE).collect() == []


def test_encoder_has_the_ids_of_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own, r = encoder(BYTE_BPE), random.Random(9)
    signs = list("abZé ß.,!?'st\n\t  12²日😀") + ["<|endoftext|>"]
    texts = [*ODD[1:], *("".join(r.choice(signs) for _ in range(40)) for _ in range(500))]
    assert [own(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert own("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_pieces_equal_the_library():
    own, r = PieceCodec(PIECES), random.Random(1)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    signs = list("abcdeéßX.,!?*$#▁  \n\t12_²日本😀'()-")
    for t in [*ODD[1:], *("".join(r.choice(signs) for _ in range(r.randint(1, 60))) for _ in range(800))]:
        ids = library.encode(t, add_eos=True)
        joined, text = next(own.encode_joined([t]))
        assert joined == " ".join(map(str, ids)) and text == library.decode(ids) == own.decode(ids)
        assert own._by_heap(t) == own._by_list(t) if t else True
    for _ in range(300):
        ids = [r.randrange(library.get_piece_size()) if r.random() < 0.5 else r.randrange(300) for _ in range(20)]
        assert own.decode(ids) == library.decode(ids)


def test_piece_frames(docs):
    texts = [*ODD, "word " * 20000]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = [library.encode(t or "", add_eos=True) for t in texts]
    frame = docs(texts)
    for r in digests(frame, PIECES).collect():
        own = ids[r.doc_id]
        want = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, own)), library.decode(own))]
        assert tuple(r)[1:] == (len(own), *want)
    encoded = encode(frame, PIECES)
    assert {r.doc_id: r.ids for r in encoded.collect()} == dict(enumerate(ids))
    assert {r.doc_id: r.text for r in decode(encoded, PIECES).collect()} == {i: library.decode(x) for i, x in enumerate(ids)}
    assert digests(docs([]), PIECES).collect() == []
