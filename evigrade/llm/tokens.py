"""Token ids with a cache by white-space-delimited chunk.

The vocabulary's pre-tokens never hold white space and byte pairs never merge
across pre-tokens, so a text's ids are those of its chunks in order.  A worker
keeps each chunk's ids; most chunks of a corpus are then looked up.  New ones
are split into pre-tokens and merged by tiktoken's core over the same
vocabulary, where byte 0xFF, which UTF-8 never holds, stands for the end of a
word.  Texts with characters outside the ranges where normalising is plain
lower-casing go to the tokenizer whole.
"""

from __future__ import annotations

import json
import re
from array import array

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Chunks that a worker keeps at most before it starts anew.
CACHE = 600_000

_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡¿«»À-ÖØ-įı-ſ‐-‧]*")
_LETTERS = "a-zß-öø-ſ"
#: The vocabulary's pre-tokenizer over plain lower-case text.
_WORD_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_END = b"\xff"


def byte_alphabet() -> dict[str, int]:
    """The printable character of byte-level vocabularies for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of word_bpe_49k.json (or a file of the same kind) without special tokens."""

    def __init__(self, path: str):
        self.path = path
        self.whole = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        letters = byte_alphabet()
        ranks = {_END: 1 << 30}
        for token, rank in vocabulary.items():
            if token not in special:
                ends = token.endswith("</w>")
                ranks[bytes(letters[c] for c in token[: -4 if ends else None]) + _END * ends] = rank
        merges = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.merge = merges._core_bpe.encode_single_piece

    def _encode_whole(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        ids = array("I")
        for word in _WORD_SPLIT.findall(chunk):
            ids.extend(self.merge(word.encode() + _END))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text or not _PLAIN.fullmatch(text):
            return self._encode_whole(text)
        chunks = text.lower().split()
        ids = list(map(self.known.get, chunks))
        if None in ids:
            if len(self.known) > CACHE:
                self.known.clear()
            for i, known in enumerate(ids):
                if known is None:
                    chunk = chunks[i]
                    ids[i] = self.known[chunk] = self.known.get(chunk) or self._encode_chunk(chunk)
        return b"".join(ids)


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(name: str = "word_bpe_49k.json") -> WordTokenizer:
    """This worker's tokenizer for a vocabulary file of public_tokenizers, or for a path."""
    if name not in _loaded:
        _loaded[name] = WordTokenizer(name if "/" in name else public_tokenizers.path(name))
    return _loaded[name]
