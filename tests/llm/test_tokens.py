import base64
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers as tokenizer_files

from gatelog.llm import byte_bpe, token_counts

BPE = tokenizer_files.path("byte_bpe_50k.tiktoken")
PIECES = tokenizer_files.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizer_files.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=300):
    chance = random.Random(5)
    alphabets = ("a", "ab", "aé日😀", "' \n\t　a1é²\x1c\x85_", "the cat's 12 ", "\r\n  x")
    return ["", " ", "\x00", "a" * 30_000, *("".join(chance.choices(a, k=chance.randrange(1, 400))) for a in alphabets for _ in range(n // 6))]


def test_ids_equal_the_library_and_decode_to_the_text(library):
    own = byte_bpe.encoder(BPE, tokenizer_files.PATTERN)
    for text in odd_texts():
        packed = own.packed(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert own.decoded(packed) == text.encode()
    assert not any(own.words)  # the bitmap is empty between pre-tokens


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 10)
    own = byte_bpe.Encoder(BPE, tokenizer_files.PATTERN)
    for text in odd_texts(60):
        assert np.frombuffer(own.packed(text), "<u4").tolist() == library.encode_ordinary(text)
        assert len(own) <= 10 and len(own.old) <= 10


def test_tables(odd_docs, library):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(odd_docs, BPE, tokenizer_files.PATTERN).collect()}
    want = set()
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == want
    back = byte_bpe.decode(byte_bpe.encode(odd_docs, BPE, tokenizer_files.PATTERN), BPE, tokenizer_files.PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert byte_bpe.digests(odd_docs.limit(0), BPE, tokenizer_files.PATTERN).collect() == []


@pytest.mark.parametrize("by_bytes", [True, False])
def test_counts_equal_the_library(by_bytes):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = [p for p in token_counts.vocabulary(PIECES) if by_bytes or not p[0].startswith("<0x")]
    library = Tokenizer(models.Unigram(pieces, 0, byte_fallback=by_bytes))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [*odd_texts(), "▁", "a▁▁b", "  ", "a  b ", "꙰꙰x日本", "lorem ipsum dolor"]
    own = token_counts.Counter(pieces)
    assert [own.total(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts)]


def test_ties_prefer_the_longest_last_piece():
    own = token_counts.Counter([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0)])
    assert own.count("aaaa") == 2  # of equal scores: a + aaa


def test_count_tables(odd_docs):
    own = token_counts.counter(PIECES)
    counted = token_counts.count_tokens(odd_docs, PIECES)
    assert counted.columns == [*odd_docs.columns, "n_tokens"]
    assert all(r.n_tokens == own.total(r.text or "") for r in counted.collect())
    assert token_counts.by_row(odd_docs.limit(0), PIECES).collect() == []
