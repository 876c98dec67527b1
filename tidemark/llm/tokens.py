"""Token ids of whole texts by a public tokenizer, as little-endian binary.

The vocabulary's pre-tokenizer never joins characters across ASCII white space, so a text's ids are those of its words
one after another. A worker keeps the ids of words it has met (at most ``CACHE`` of them, whatever the input) and asks
the tokenizers library for the others only. A word of letters that the normalizer leaves alone goes to the library's
model at once, any other through the whole tokenizer.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from tidemark.llm.common import held

#: Words whose ids a worker remembers: bounds its memory; beyond it words are encoded each time they come.
CACHE = 600_000
VOCABULARY = "word_bpe_49k.json"


class _Words(dict):
    """Ids of words; a new word is encoded when it is first asked for."""

    def __init__(self, tokenizer, kind: np.dtype):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.model, self.type = tokenizer, tokenizer.model, kind
        self.bytes_as_letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, word: bytes) -> bytes:
        coded = self._encode(word)
        if len(self) < CACHE:
            self[word] = coded
        return coded

    def _encode(self, word: bytes) -> bytes:
        if len(word) > 2 and word[-1] in b".," and word[-2:-1].isalnum():  # always two pieces for this vocabulary
            return self[word[:-1]] + self[word[-1:]]
        if word.isalpha() and word.islower():  # ASCII letters: one piece, left as it is by the normalizer
            ids = [t.id for t in self.model.tokenize(word.decode())]
        else:
            text = word.decode()
            if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                ids = [t.id for t in self.model.tokenize(self.bytes_as_letters(text)[0][0])]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, self.type).tobytes()


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.width = 2 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.type = np.dtype("<u2" if self.width == 2 else "<u4")
        self.known = _Words(tokenizer, self.type)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids, as bytes of ``type``. A text with the beginning of a special token keeps its capitals."""
        ids = self.known.__getitem__
        return [b"".join(map(ids, (t if b"<|" in t else t.lower()).split())) for t in texts]


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker, until it serves another vocabulary or operator."""
    return held(f"words of {path}", lambda: WordEncoder(path))


def public_path(name: str = VOCABULARY) -> str:
    """The place of a public tokenizer's file on the machine where this runs."""
    import public_tokenizers

    return public_tokenizers.path(name)
