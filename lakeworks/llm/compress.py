"""Sizes of texts compressed with raw-content dictionaries, shared by the two compression classifiers."""

from __future__ import annotations

import zstandard

#: Texts are compressed in independent pieces, so that a dictionary, not the text's own past, explains them.
PIECE = 4096


def compressors(dictionaries: dict[str, bytes], level: int) -> dict[str, zstandard.ZstdCompressor]:
    """One compressor per dictionary; frames carry no magic number, size or checksum."""
    params = zstandard.ZstdCompressionParameters.from_level(
        level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    found = {}
    for name, content in dictionaries.items():
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(compression_params=params)
        found[name] = zstandard.ZstdCompressor(dict_data=own, compression_params=params)
    return found


def pieces(text: bytes, size: int = PIECE) -> list[bytes]:
    """The whole text in pieces; one empty piece for an empty text."""
    return [text[k : k + size] for k in range(0, max(1, len(text)), size)]


def fill(texts: list[str], size: int) -> bytes:
    """Dictionary content of at most ``size`` bytes."""
    return "\n".join(texts).encode()[:size]
