"""The public vocabulary the queries use; its file's place is a parameter."""

from __future__ import annotations

from functools import cache

import public_tokenizers

from sequon.llm.bpe import Vocabulary


@cache
def byte_bpe(path: str | None = None) -> Vocabulary:
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Vocabulary.read(path, public_tokenizers.PATTERN)
