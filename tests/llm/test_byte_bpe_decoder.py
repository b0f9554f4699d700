import public_tokenizers

from galepost.llm import byte_bpe
from galepost.llm.queries import BYTE_RANKS


def test_decoder_gives_the_text_back_without_an_encoder():
    ranks = public_tokenizers.path(BYTE_RANKS)
    encoder = byte_bpe.PieceEncoder(ranks, public_tokenizers.PATTERN, entries=5)
    decoder = byte_bpe.PieceDecoder(ranks)
    for text in ("", "Plain words, twice plain words.\n", "ünï 中文 \U0001f600\x00", "x" * 300):
        assert decoder.decode(encoder.encode(text)) == text.encode()
    assert not hasattr(decoder, "codec")


def test_few_pieces_are_kept():
    assert byte_bpe.CACHED_PIECES <= 1 << 16
