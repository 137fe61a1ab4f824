"""Tokenizing inside tasks with a byte-level BPE vocabulary file.

The vocabulary's file is named by a parameter and opened on the executors
(it is installed there, or shipped with ``spark.files``); each worker
process loads it once.  Two libraries read the same vocabulary: the ``.json``
file is the reference, the ranks of the ``.tiktoken`` file beside it give
the same ids several times faster.  They may differ only in what their
Unicode tables call a letter or a number, so texts with characters outside
long-settled blocks go to the reference.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np

#: Blocks of which every character has long been assigned to its class, or
#: is a mark or sign in any version.
_SETTLED = re.compile(
    "[^\u0000-ɏΑ-ΡΣ-ϿЀ-ҁ‐-‧‰-⁞"
    "€™←-⇿ぁ-ゖァ-ヺ一-龥가-힣]"
)
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """One vocabulary as both libraries read it."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.reference = Tokenizer.from_file(path)
        added = self.reference.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.fast = None
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_path):
            with open(ranks_path, "rb") as lines:
                pairs = map(bytes.split, lines)
                ranks = {base64.b64decode(a): int(b) for a, b in pairs}
            self.fast = tiktoken.Encoding(
                os.path.basename(path), pat_str=_PATTERN, mergeable_ranks=ranks,
                special_tokens=self.special,
            )
            self.ranks = ranks

    def settled(self, text: str) -> bool:
        return self.fast is not None and (text.isascii() or not _SETTLED.search(text))

    def ids(self, text: str) -> np.ndarray:
        """The token ids of a text, special strings read as special tokens."""
        if self.settled(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.asarray(self.reference.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def count(self, text: str) -> int:
        if self.settled(text):
            return len(self.fast.encode(text, allowed_special="all"))
        return len(self.reference.encode(text, add_special_tokens=False).ids)

    @functools.cached_property
    def alone(self) -> frozenset[str]:
        """Words w for which " w" encodes alone as one token.

        Proved by encoding every vocabulary string that is a blank and then
        characters without white space: it stays when the outcome is the one
        token itself, which also proves that it is one pre-token.
        """
        words = []
        for token, rank in self.ranks.items():
            text = token.decode("utf-8", "ignore")
            if len(text) < 2 or text[0] != " " or text.encode() != token or re.search(r"\s", text[1:]):
                continue
            if self.fast.encode_ordinary(text) == [rank]:
                words.append(text[1:])
        return frozenset(words)

    @functools.cached_property
    def alone_and_mark(self) -> frozenset[str]:
        """Words w and a mark m for which " wm" encodes as two tokens.

        ``w`` is all letters and stands alone, so the mark begins a new
        pre-token; both were encoded together to prove it.
        """
        encode = self.fast.encode_ordinary
        return frozenset(
            w + m for w in self.alone if w.isalpha() for m in ".," if len(encode(f" {w}{m}")) == 2
        )


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
