"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re

import numpy as np


#: Added tokens of the vocabulary's JSON file.
ADDED = {"<|endoftext|>": 50256}


#: From a run of about a million characters of white space on, the pattern engine of ``tiktoken`` gives up. A run's start is
#: looked for, so the search is linear.
LONG_BLANK = 1 << 17
_LONG_BLANK = re.compile(r"(?<!\s)\s{%d}" % LONG_BLANK)


class Encoder:
    """Ids as ``tokenizers`` gives them for the vocabulary's JSON file (no special tokens added; ``added``:
    the strings of its added tokens get their ids, as it does by default, else they are ordinary text). The merging itself is done by ``tiktoken`` from the same vocabulary's rank file:
    the ids are equal (tested) and come about four times as fast. Texts with ``LONG_BLANK`` or more characters of white space in a
    run go to ``tokenizers`` itself."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.slow: dict = {}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                        special_tokens=ADDED).encode_to_numpy

    def ids(self, text: str | None, added: bool = False) -> np.ndarray:
        """uint32 ids; a null text counts as empty."""
        if not text:
            return np.empty(0, dtype=np.uint32)
        if len(text) >= LONG_BLANK and _LONG_BLANK.search(text):
            return np.array(self._unchanged(added).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.encode(text, allowed_special="all" if added else set(), disallowed_special=())

    def _unchanged(self, added: bool):
        """The vocabulary's ``tokenizers`` object, loaded when first needed; its added tokens are ordinary text unless ``added``."""
        if added not in self.slow:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.slow[added] = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            self.slow[added].encode_special_tokens = not added
        return self.slow[added]


_ENCODERS: dict[str, Encoder] = {}


def encoder(ranks: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if ranks not in _ENCODERS:
        _ENCODERS[ranks] = Encoder(ranks)
    return _ENCODERS[ranks]


def byte_bpe() -> str:
    """Place of the byte-level BPE vocabulary's rank file; asked for where it is used, never copied."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")
