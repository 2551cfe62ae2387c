"""Token ids of the public byte-level BPE, loaded once in a worker process.

The vocabulary comes as a tokenizer file and, the same, as ranks.  The ranks'
library gives the same ids (tests/llm holds the two together) at about five
times the speed.  ``ids`` takes strings of special tokens as ordinary text;
``file_ids`` gives the ids of the tokenizer file as it is, special ids included.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers

TOKENIZER_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_50k.tiktoken"
#: Longest run of characters of one class that is given to the rank library,
#: whose pattern matcher has a stack; other texts go to the tokenizer file.
LONG_RUN = 2000
#: The string of the tokenizer file's special token.
SPECIAL = "<|endoftext|>"


class Encoder:
    def __init__(self, tokenizer_file: str, rank_file: str):
        import tiktoken

        self.tokenizer_file, self.slow, self.plain = tokenizer_file, None, None
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 2  # the special token's id is the last

    def ids(self, text: str) -> np.ndarray:
        if len(text) > LONG_RUN and max(map(len, text.split(" "))) > LONG_RUN or " " * 64 in text:
            return self._whole(text)
        return np.asarray(self.fast.encode_ordinary(text), np.uint32)

    def file_ids(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return self.ids(text)
        if self.plain is None:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_file(self.tokenizer_file)
        return np.asarray(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)

    def _whole(self, text: str) -> np.ndarray:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.tokenizer_file)
            self.slow.encode_special_tokens = True
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def text(self, ids) -> str:
        return self.fast.decode_bytes(ids.tolist() if isinstance(ids, np.ndarray) else list(map(int, ids))).decode("utf-8")


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str | None = None, rank_file: str | None = None) -> Encoder:
    return Encoder(tokenizer_file or public_tokenizers.path(TOKENIZER_FILE), rank_file or public_tokenizers.path(RANK_FILE))
