import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from tapflow.llm import dac as m  # noqa: E402
from tapflow.session import scratch_path  # noqa: E402

NAME = "byte_bpe_50k.json"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=2500), st.data())
def test_segment_round_trip(ids, data):
    cut = data.draw(st.integers(0, len(ids)))
    s = m.Segment(m.write_segment(np.array(ids, np.uint32), [7, None], [0, cut]))
    assert s.slice(0, len(ids)).tolist() == ids and s.doc_ids == [7, None]
    assert s.slice(cut, len(ids)).tolist() == ids[cut:]
    for i in range(0, len(ids), max(1, len(ids) // 40)):
        assert s.token(i) == ids[i]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdé½²\x1c\x85 一가<|")), max_size=60))
def test_pieces_equal_the_tokenizer(text):
    enc = m.encoder(m._resolve(NAME))
    assert enc.by_piece
    assert enc.encode(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("segment_tokens", [m.SEGMENT_TOKENS, 5])
def test_files_hold_all_documents(prepared, docs, segment_tokens):
    path = scratch_path(prepared, "dac-test")
    m.write_tokens(docs, path, NAME, 2, segment_tokens=segment_tokens)
    tok = m.encoder(m._resolve(NAME)).tokenizer
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start, want = 0, []
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(m.read_entries(prepared, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_empty(prepared, no_docs):
    path = scratch_path(prepared, "dac-empty")
    m.write_tokens(no_docs, path, NAME, 2)
    assert m.read_entries(prepared, path).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["word", "Word,", "don't", "x's", "'s", "a.", ".", "..", "é!", "12", "a\n", "\nb", "", "", "\t",
                                 "\xa0", "½", "_a", "a_;", "中文?", "<|x|>", "x.\nY", "\x1c"]), max_size=12))
def test_words_equal_the_tokenizer(parts):
    """Parts between spaces are encoded by themselves only where the tokenizer
    cuts there, whatever white space, marks and unsure characters meet."""
    enc, text = m.encoder(m._resolve(NAME)), " ".join(parts)
    assert enc.encode(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once(monkeypatch):
    """A word seen before costs a look-up, also behind a mark; no text is cut
    into pieces again for words that are known."""
    enc, seen = m.PieceEncoder(m._resolve(NAME)), []
    monkeypatch.setattr(enc, "tokenized", lambda piece, of=enc.tokenized: (seen.append(piece), of(piece))[1])
    want = enc.tokenizer.encode("so many words, many words", add_special_tokens=False).ids
    for _ in range(4):
        assert enc.encode("so many words, many words").tolist() == want
    assert sorted(seen) == [" many", " words", ",", "so"]
    long = "a-" * 100
    assert enc.encode(f"x {long}").tolist() == enc.tokenizer.encode(f"x {long}", add_special_tokens=False).ids
    assert long not in enc.words                 # memory is bounded by words, not by texts without spaces


_BITS = st.sampled_from(["word", "Word", "don't", "'s", ".", ",", "!", "é", "12", "\n", "\n\n", "\t", "\r\n", " ", "  ", "\xa0", "½",
                         "_", "中", "<|endoftext|>", "\x0b", "\x1c"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(_BITS, max_size=8).map("".join)), max_size=6))
def test_chunks_equal_the_tokenizer(texts):
    """Lines and marks taken off, knotty white space and nulls: every run of
    texts has the tokenizer's ids, and the tail after each text."""
    enc = m.encoder(m._resolve(NAME))
    want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    codes = m.ChunkCodes(enc, pa.array(texts, pa.string()), np.array([2], enc.dtype).tobytes())
    assert codes.counts.tolist() == [len(w) for w in want]
    for a in range(len(texts) + 1):
        for b in range(a, len(texts) + 1):
            assert codes.ids(a, b).tolist() == sum(want[a:b], [])


def test_words_of_a_chunk_are_looked_up_once(monkeypatch):
    """Neither repeats nor marks nor line ends around a word cost another look-up."""
    enc, met = m.PieceEncoder(m._resolve(NAME)), []
    monkeypatch.setattr(m.WordCodes, "__getitem__", lambda self, w: (met.append(w), dict.__getitem__(self, w))[1], raising=False)
    texts = ["a word, a word. some word\nword word;", None, "the word!\nword, word? some"] * 3
    codes = m.ChunkCodes(enc, pa.array(texts, pa.string()))
    assert codes.ids(0, 9).tolist() == [i for t in texts for i in enc.tokenizer.encode(t or "", add_special_tokens=False).ids]
    assert sorted(met) == ["a", "some", "word", "word"]     # "word" behind a space, and behind a line end


def test_words_met_again_stay_known(monkeypatch):
    """Memory is bounded, but frequent words are not forgotten with the rare."""
    enc, seen = m.PieceEncoder(m._resolve(NAME)), []
    monkeypatch.setattr(enc, "tokenized", lambda piece, of=enc.tokenized: (seen.append(piece), of(piece))[1])
    monkeypatch.setattr(m, "_WORD_LIMIT", 40)
    letters = "abcdefghij"
    for k in range(30):
        rare = " ".join(f"rare{letters[k // 10]}{letters[k % 10]}{x}{y}" for x in letters for y in "xy")
        enc.encode(f"so many {rare} words")
        assert len(enc.words) <= 40
    assert seen.count(" many") == seen.count(" words") == 1 and len(seen) == 30 * 20 + 2 + seen.count("so")
