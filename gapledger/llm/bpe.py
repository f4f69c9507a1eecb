"""Byte-pair vocabularies of tokenizer files, merged by tiktoken's core.

``tokenizers`` takes some 15 microseconds for a word it has not met, tiktoken's merge
loop about two. Both give the same tokens where merges stand in the order of the ids
they make; that is checked when a file is read, and a file without that order is refused.
"""

from __future__ import annotations

import json

from gapledger.llm.workers import worker_memo

#: Stands for the end of a word; no byte of UTF-8.
WORD_END = b"\xff"
_SUFFIX = "</w>"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: its own, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes to id; tokens that end a word end in ``WORD_END``."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, byte_of = model["vocab"], _byte_of()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first, second = pairs[0]
    start = vocabulary[first.removesuffix(_SUFFIX) + second]
    if any(vocabulary[a + b] != start + i for i, (a, b) in enumerate(pairs)):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    ranks = {}
    for token, i in vocabulary.items():
        end = WORD_END if token.endswith(_SUFFIX) else b""
        if all(c in byte_of for c in token.removesuffix(_SUFFIX)):
            ranks[bytes(byte_of[c] for c in token.removesuffix(_SUFFIX)) + end] = i
    # The core wants every single byte to have an id.
    for b in range(256):
        ranks.setdefault(bytes([b]), len(vocabulary) + b)
    return ranks


def load_core(path: str):
    """tiktoken's core over the file's ranks."""
    import public_tokenizers
    import tiktoken

    def make():
        return tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={}
        )._core_bpe

    return worker_memo(("bpe_core", path), make)


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return worker_memo(("tokenizer", path), lambda: Tokenizer.from_file(path))
