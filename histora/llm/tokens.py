"""Token ids of whole texts, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import os
import re

SEPARATOR = b"\x00\x00\x00\x00"

_LOADED: dict[str, TextTokenizer] = {}
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextTokenizer:
    """The ids that `tokenizers` gives for whole texts, without added special tokens.

    If the same vocabulary lies beside the file as ranks, `tiktoken` encodes texts in Latin letters: the same ids in a
    quarter of the time. Texts with other letters, where the libraries may know different versions of Unicode, and
    texts with the special token stay with `tokenizers`.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole, self.merger = Tokenizer.from_file(path), None
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.merger = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """By `tokenizers` alone."""
        import numpy as np

        batch = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in batch]

    def ids(self, texts: list[str]) -> list[bytes]:
        if self.merger is None:
            return self.encode(texts)
        latin = [not _BEYOND_LATIN.search(t) and not any(s in t for s in self.special) for t in texts]
        others = iter(self.encode([t for t, own in zip(texts, latin, strict=True) if not own]))
        return [self.merged(t) if own else next(others) for t, own in zip(texts, latin, strict=True)]

    def merged(self, text: str) -> bytes:
        return self.merger.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def tokenizer(path: str) -> TextTokenizer:
    """One tokenizer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = TextTokenizer(path)
    return _LOADED[path]
