"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

The file gives vocabulary and merges. Its ids are ranks (each merge makes the next id), so the
merges can be run by tiktoken, which is several times faster on whole texts. The file's own
library encodes the texts that hold the name of an added token, and a share of all others,
chosen by their hash, as well; a difference ends the job.
"""

from zlib import crc32

import numpy as np
import public_tokenizers

_CHECKED_OF = 64


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Ids of texts, as the tokenizers library gives them for the file as it stands: the name of
    a special token in a text becomes that token. ``encoding`` alone takes names as text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.reference = Tokenizer.from_file(path)
        characters = _bytes_of_characters()
        vocabulary = self.reference.get_vocab(with_added_tokens=False)
        special = {t.content for t in self.reference.get_added_tokens_decoder().values()}
        self.names = sorted(special)
        ranks = {
            bytes(characters[c] for c in token): number
            for token, number in vocabulary.items()
            if token not in special
        }
        self.encoding = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        text = text or ""
        if any(name in text for name in self.names):
            ids = self.reference.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_ordinary(text)
            if crc32(text.encode()) % _CHECKED_OF == 0:
                if ids != self.reference.encode(text, add_special_tokens=False).ids:
                    raise ValueError("the tokenizer file is not a byte-level BPE in rank order")
        return np.asarray(ids, "<u4").tobytes()


_encoders: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The encoder of a file, one per worker."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]
