"""Token counts with a whole-token shortcut.

Offline, from the vocabulary file alone, every vocabulary string that ends a word is
encoded by itself; those that come back as exactly that one token are proven whole.
A text is cut at blanks and line feeds, which no pre-token of such a vocabulary
spans, then into pre-tokens. A pre-token that is a proven string counts one without
any merging; only the rest goes through the tokenizer's merges. Each piece between
blanks is counted once per task and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.bpe import WORD_END, load_core, load_tokenizer
from gapledger.llm.text import free_name
from gapledger.llm.workers import BoundedMemo, worker_memo

_MEMORY = 300_000
#: Pre-tokens of lower-case text of the characters below.
_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")
#: Printable ASCII and Latin letters, without what could begin a special token. Other
#: characters, whose classes depend on a Unicode version, are left to the tokenizer.
_PLAIN = re.compile("[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")


def whole_tokens(path: str) -> frozenset[str]:
    """ASCII vocabulary strings that are proven to encode alone as their own token."""
    tokenizer = load_tokenizer(path)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    words = [w.removesuffix("</w>") for w in vocabulary if w.endswith("</w>")]
    words = [w for w in words if w and _PLAIN.fullmatch(w) and _PRE_TOKEN.fullmatch(w)]
    found = tokenizer.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, found, strict=True) if e.ids == [vocabulary[w + "</w>"]])


class TokenCounter(BoundedMemo):
    """Piece of text without blanks and line feeds: its number of tokens."""

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        super().__init__(_MEMORY)
        self.tokenizer, self.core, self.whole = load_tokenizer(path), load_core(path), whole

    def _merged(self, pre_token: str) -> int:
        return len(self.core.encode_single_piece(pre_token.encode() + WORD_END))

    def make(self, piece: str) -> int:
        lowered = piece.lower()
        if lowered in self.whole:
            return 1
        if _PLAIN.fullmatch(piece):
            return sum([1 if p in self.whole else self._merged(p) for p in _PRE_TOKEN.findall(lowered)])
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        self.turn()
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def count_tokens(
    docs: DataFrame, tokenizer_path: str, text_column: str = "text", count_column: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text, as the library gives it.

    For vocabularies that drop white space, lower the case and end words by ``</w>``.
    No begin, end or added special tokens; special strings inside a text are handled as
    the library does by default. A null or empty text has 0. A column of ``docs`` named
    like the new one gives way; other columns, repeated rows and empty tables stay.
    """
    whole = whole_tokens(tokenizer_path)

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_memo(("token_counter", tokenizer_path), lambda: TokenCounter(tokenizer_path, whole))
        for texts in batches:
            yield pa.array([counter.count(t.as_py() or "") for t in texts], pa.int64())

    count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    counted = F.arrow_udf(count, "long").asNondeterministic()
    kept = [c for c in docs.columns if c != count_column]
    found = free_name(docs, "_found")
    return docs.withColumn(found, counted(F.col(text_column).cast("string"))).select(
        *kept, F.col(found).alias(count_column)
    )
