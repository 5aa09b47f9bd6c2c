"""Token counts, SentencePiece encoding and packing against the libraries themselves."""

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import EDGE, edge, empty

from martlake.llm import packing, sentencepieces, token_counts
from martlake.llm.columns import text_bytes
from martlake.llm.pieces import Memo, byte_lengths, once, piece_ids, safe_pieces, spread, white_cuts

BPE, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


TEXT = st.text(st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" \n\t'<|>\x1c 　s")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_pieces_keep_the_tokens(text):
    from tokenizers import Tokenizer
    lib = test_pieces_keep_the_tokens.__dict__.setdefault("lib", Tokenizer.from_file(BPE))
    pieces = safe_pieces(text)
    assert "".join(pieces) == text
    assert [i for p in pieces for i in ids_of(lib, p)] == ids_of(lib, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXT, st.sampled_from([" <|endoftext|>", "\x1cfoo", "!", "  ", " a", "'s"])), max_size=30))
def test_joined_pieces_keep_their_ids(texts):
    from tokenizers import Tokenizer
    own = test_joined_pieces_keep_their_ids.__dict__
    if "lib" not in own:
        own["lib"] = Tokenizer.from_file(BPE)
        own["size"] = byte_lengths(own["lib"])
    new = [p for t in texts for p in safe_pieces(t)]
    assert [np.frombuffer(x, "<i4").tolist() for x in piece_ids(own["lib"], own["size"], new)] == [ids_of(own["lib"], p) for p in new]
    wrong = own["size"] + 1  # no cut fits: each piece alone
    assert [np.frombuffer(x, "<i4").tolist() for x in piece_ids(own["lib"], wrong, new)] == [ids_of(own["lib"], p) for p in new]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_texts_get_the_ids_of_their_distinct_pieces(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer
    lib = once(("test", BPE), lambda: Tokenizer.from_file(BPE))
    data, offsets = text_bytes(pa.array(texts * 2, pa.string()))
    seen = []

    def values(pieces):
        seen.extend(pieces)
        return [np.array(ids_of(lib, p), "<i4").tobytes() + b"!" * ("\x1c" in p) for p in pieces]

    ids, ends, extra = spread(data, offsets, white_cuts(data), values)
    assert [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:], strict=True)] == [ids_of(lib, t) for t in texts] * 2
    assert len(seen) == len(set(seen)) and (extra > 0).tolist() == ["\x1c" in t for t in texts] * 2


def test_counts(spark, library):
    got = sorted(map(str, token_counts.count_tokens(edge(spark), BPE, limit=10).collect()))
    from pyspark.sql import Row
    want = [Row(doc_id=d, n_bytes=len((t or "").encode()), n_tokens=n, over_limit=n > 10)
            for d, t in EDGE for n in [len(ids_of(library, t))]]
    assert got == sorted(map(str, want))
    assert token_counts.count_tokens(empty(spark), BPE).collect() == []


def test_sentencepiece_matches_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = sentencepieces.encode(edge(spark), MODEL).collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == sorted((str(d), sp.encode(t or "")) for d, t in EDGE)
    assert all(r.parity and r.n_tokens == len(r.ids) for r in rows)
    texts = {d: t for d, t in EDGE}
    for r in rows:
        if r.doc_id is not None:
            assert r.decoded == sp.decode(list(r.ids)) == (texts[r.doc_id] or "").replace("▁", " ")
    assert sentencepieces.encode(empty(spark), MODEL).collect() == []


def test_sentencepiece_decode(spark):
    enc = sentencepieces.encode(edge(spark), MODEL)
    back = sentencepieces.decode(enc, MODEL)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == \
        sorted((str(d), (t or "").replace("▁", " ")) for d, t in EDGE)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_sentencepiece_parity_is_of_the_backend(text):
    c = sentencepieces.codec(MODEL)
    (ids, parity, decoded), = c.encode([text])
    assert np.frombuffer(ids, "<i4").tolist() == c.reference.encode(text)
    assert parity
    assert decoded == text.replace("▁", " ")


def test_new_chunks_are_encoded_as_few_strings():
    c = sentencepieces.Codec(MODEL)
    class Library:
        given = 0
        def encode(self, texts, **how):
            Library.given += len(texts)
            return own.encode(texts, **how)
    own, c.reference = c.reference, Library()
    text = " ".join(f"word{i}" for i in range(2000))
    (ids, parity, decoded), = c.encode([text])
    assert np.frombuffer(ids, "<i4").tolist() == own.encode(text) and parity and decoded == text
    assert Library.given <= 10


def test_where_the_libraries_differ_the_reference_counts():
    c = sentencepieces.Codec(MODEL)
    class Library:
        def encode(self, texts, **how):
            return [[*own.encode(t), 65] if "odd" in t else own.encode(t) for t in texts]
    own, c.reference = c.reference, Library()
    (a, pa_, da), (b, pb, db) = c.encode(["an odd text", "another"])
    assert np.frombuffer(a, "<i4").tolist() == [*own.encode("an odd"), 65, *own.encode("text")] and not pa_
    assert np.frombuffer(b, "<i4").tolist() == own.encode("another") and pb and db == "another"
    assert da == c.decode(np.frombuffer(a, "<i4").tolist())


def test_a_worker_forgets_chunks_after_a_task(spark):
    import pyarrow as pa
    sentencepieces.encode(edge(spark), MODEL).collect()

    def known(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(sentencepieces.codec(MODEL).memo.known)] * len(b), pa.int64())], ["n"])

    assert {r.n for r in spark.range(64).repartition(4).mapInArrow(known, "n long").collect()} == {0}


def test_unigram_model_is_rebuilt(tmp_path):
    """A small unigram model, its protobuf written here field by field."""
    import struct

    import sentencepiece

    def field(n, payload):
        return bytes([n << 3 | 2, *(len(payload).to_bytes(1, "little"))]) + payload

    def piece(p, s, t):
        return field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([3 << 3, t]))

    made = b"".join([piece("<unk>", 0, 2), piece("<s>", 0, 3), piece("</s>", 0, 3)]
                    + [piece(f"<0x{b:02X}>", -20, 6) for b in range(256)]
                    + [piece(p, s, 1) for p, s in (("▁", -3.0), ("▁the", -2.0), ("▁th", -4.0), ("e", -4.0), ("cat", -5.0),
                                                   ("c", -6.0), ("a", -6.0), ("t", -6.0), ("▁c", -5.0), ("at", -5.5))])
    trainer = bytes([3 << 3, 1]) + bytes([0x98, 0x02, 1])
    norm = field(1, b"identity") + bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1])
    path = str(tmp_path / "u.model")
    with open(path, "wb") as f:
        f.write(made + field(2, trainer) + field(3, norm))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    c = sentencepieces.Codec(path)
    assert c.model.kind == sentencepieces.UNIGRAM and c.model.byte_fallback
    for text in ("the cat", "cat the  thecat", "at ü", "", " tea"):
        (ids, parity, decoded), = c.encode([text])
        assert np.frombuffer(ids, "<i4").tolist() == sp.encode(text) and parity and decoded == text


def unpack(rows):
    """Documents put together again from packed rows: {doc_id: [ids of each copy]}, start by start."""
    parts = []
    for r in rows:
        ids, pos = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.position_ids, "<i4")
        for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert pos[a:b].tolist() == list(range(b - a))
            parts.append((d, s, ids[a:b].tolist()))
        assert r.cu_seqlens[-1] == r.n_tokens <= len(ids)
        assert (ids[r.n_tokens:] == 50256).all()
    return parts


def test_packing_is_lossless(spark, library):
    rows = packing.pack(edge(spark), BPE, 50256, length=64, block_tokens=1000).collect()
    want = []
    for d, t in EDGE:
        ids = ids_of(library, t) + [50256]
        want += [(d, s, ids[s:s + 64]) for s in range(0, len(ids), 64)]
    assert sorted(map(str, unpack(rows))) == sorted(map(str, want))
    assert packing.pack(empty(spark), BPE, 50256).collect() == []


def test_memo_makes_each_missing_piece_once():
    made = []
    memo = Memo(lambda new: made.append(sorted(new)) or [x.upper() for x in new], most=3)
    long = "x" * 100
    assert memo.values(["a", "b", "a", long]) == ["A", "B", "A", long.upper()] and made == [["a", "b", long]]
    assert memo.values(["b", "a", "a"]) == ["B", "A", "A"] and len(made) == 1 and long not in memo.known
    assert memo.values(["a", "c", "d", "c"]) == ["A", "C", "D", "C"] and made[1:] == [["c", "d"]]  # too many: forgets, but has found "a"
    assert set(memo.known) == {"c", "d"} and memo.values([]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    got = packing.best_fit_decreasing(np.array(lengths, np.int64), 50)
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(room[r], r) for r in range(len(rows)) if room[r] >= lengths[i]]
        if fits:
            r = max((x for x in fits if x[0] == min(fits)[0]), key=lambda x: 0)[1]
        else:
            rows.append([])
            room.append(50)
            r = len(rows) - 1
        rows[r].append(i)
        room[r] -= lengths[i]
    assert sorted(i for r in got for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= 50 for r in got)
    # Rows of equal room are interchangeable, so the fill of the rows is what must agree.
    assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(50 - x for x in room)
