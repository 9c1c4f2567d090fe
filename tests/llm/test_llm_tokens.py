"""Packing, SentencePiece and token counts against the libraries."""

import random
import zlib

import pytest

from conftest_helpers import by_id
from obsflow.llm import packing, pieces, token_counts
from obsflow.llm.common import PIECE_BPE_FILE, WORD_BPE_FILE, tokenizer_path
from obsflow.llm.wordbpe import word_bpe

BPE, PIECE = tokenizer_path(WORD_BPE_FILE), tokenizer_path(PIECE_BPE_FILE)
HARD = [
    "don't I'LL we've 'S'T x'lla 12.5%% ß ẞ ſ ª º µ × ÷ Ÿ İ ı ŉ",
    "ΟΔΟΣ Σ x́ é a　b l'été __a_b__ ~~ x\x1cy\x85z\xa0q",
    "a<|endoftext|>b <|startoftext|> <|",
    "漢字テスト🙂👍🏽",
    "",
    "  ",
    "ab" * 3000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_word_bpe_equals_library(library):
    from array import array

    bpe = word_bpe(BPE)
    for text in HARD:
        want = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", bpe.encode_packed(text))) == want
        assert bpe.count(text) == len(want)


def test_whole_tokens_are_proven(library):
    bpe = word_bpe(BPE)
    sample = random.Random(1).sample(sorted(bpe.whole), 300)
    assert all(library.encode(w, add_special_tokens=False).ids == [bpe.whole[w]] for w in sample)
    small = type(bpe)(BPE, cache=len(bpe.whole) + 2)  # a cache that overflows changes nothing
    assert [small.count(t) for t in HARD] == [bpe.count(t) for t in HARD]


def test_token_counts(documents, nothing, library):
    got = token_counts.token_counts(documents, BPE, limit=50).collect()
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in documents.collect()
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)
    assert token_counts.token_counts(nothing, BPE).collect() == []


def test_packing(documents, nothing, library):
    size = 64
    got = packing.packed_documents(documents, BPE, size).collect()
    want = []
    for r in documents.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            want.append((str(r.doc_id), n, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = by_id(got, "sequence_id")
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    assert len(bins) <= -(-sum(r.length for r in got) // size) * 1.05 + 1
    assert packing.packed_documents(nothing, BPE, size).collect() == []


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    assert packing.best_fit([6, 5, 4, 5], size=10) == [(0, 0), (1, 0), (0, 6), (1, 5)]
    # two open bins, with 4 and 3 places left: the next bin closes the fuller one
    assert packing.best_fit([6, 7, 8, 3, 4], size=10, open_bins=2) == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0)]


def test_pieces_equal_library(documents):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = pieces.encoded_documents(documents, PIECE).collect()
    want = sorted((str(r.doc_id), lib.encode(r.text or "")) for r in documents.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)


def test_pieces_of_hard_texts_and_batches():
    import sentencepiece
    from array import array

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model = pieces.PieceModel(PIECE)
    texts = [*HARD, "  a  b ", "▁x▁ ▁▁y", "aaaaaaaaaaaaaaaaaaaaaaaaa", "<s></s><unk><0x0A>", "hhhhhh       mmm   "]
    got = [list(array("i", p)) for p in model.encode_batch(texts)]
    assert got == [lib.encode(t) for t in texts]
    assert [model.decode(i) for i in got if True] == [t.replace("▁", " ") for t in texts]
    assert [model.encode_batch([t])[0] for t in texts] == model.encode_batch(texts)


def test_unigram_forward_scores(tmp_path):
    """The additive pass finds the best sum of scores, on a file marked as unigram."""
    from array import array

    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECE, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pieces.UNIGRAM
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    own = pieces.PieceModel(str(path))

    def best(word):
        found = [0.0]
        for end in range(1, len(word) + 1):
            found.append(max((found[k] + own.score[own.ids[word[k:end]]] for k in range(end) if word[k:end] in own.ids), default=float("-inf")))
        return found[-1]

    for text in ["the quick brown fox", "nation and action", "interoperability", "abababab"]:
        ids = list(array("i", own.encode_batch([text])[0]))
        assert own.decode(ids) == text
        assert sum(own.score[i] for i in ids) == pytest.approx(sum(best(w) for w in own.marked_words(text)))


def test_pieces_empty_table(nothing, spark):
    assert pieces.encoded_documents(nothing, PIECE).collect() == []
    nulls = pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PIECE).collect()
    assert [r.decoded for r in nulls] == [None, ""]
