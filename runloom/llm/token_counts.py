"""Token counts with a shortcut for words that are a token of their own.

Which strings of the vocabulary encode alone as exactly one token is settled before any
text is read (``prove_whole_tokens``). A pre-token of a text that is among them counts
one without merging; only the rest goes through the merges of the tokenizer's model, each
distinct string once per worker while the bounded memo holds it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most strings that a worker remembers besides the proven ones.
MEMO_LIMIT = 400_000
#: A text with any other character is encoded by the library as a whole: the character
#: classes of these ranges are the same in the tokenizer and in the ``regex`` module.
SAFE = "\u0000-԰ -‿぀-ヿ一-龥가-힣"
UNSAFE = re.compile(f"[^{SAFE}]")
#: White space after a blank, or a blank at either end: there a word does not split alone.
BLANK_RUN = re.compile(r" \s|\A | \Z")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte.

    Printable bytes stand for themselves; the others are numbered upwards from U+0100.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(others)}


@lru_cache(maxsize=4)
def prove_whole_tokens(path: str) -> frozenset[str]:
    """Strings of the vocabulary that the library encodes alone as one token.

    Each string is split and merged by the tokenizer itself: it must be one pre-token and
    that pre-token must merge into a single token. Vocabulary strings that are no valid
    text, or that their own merges cannot reach, are not among them.
    """
    tokenizer = _tokenizer(path)
    bytes_of = {letter: byte for byte, letter in byte_letters().items()}
    texts = []
    for string in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(bytes_of[c] for c in string).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    whole = zip(texts, encoded, strict=True)
    return frozenset(t for t, e in whole if len(e.ids) == 1 and e.offsets == [(0, len(t))])


class TokenCounter:
    """Counts the tokens of texts as the library does, without special tokens around them."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        self.tokenizer = _tokenizer(path)
        kind = type(self.tokenizer.pre_tokenizer).__name__
        if kind != "ByteLevel" or self.tokenizer.normalizer is not None:
            raise ValueError("only byte-level vocabularies without a normalizer are supported")
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_cut = re.compile(cut) if cut else None
        self.whole = prove_whole_tokens(path)
        self.merged: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def _merge(self, pre_token: str) -> int:
        known = self.merged.get(pre_token)
        if known is None:
            if len(self.merged) >= MEMO_LIMIT:
                self.merged.clear()
            string = pre_token.encode().decode("latin-1").translate(self.letters)
            known = len(self.tokenizer.model.tokenize(string))
            self.merged[pre_token] = known
        return known

    def _pre_tokens(self, text: str) -> int:
        whole = self.whole
        return sum(1 if p in whole else self._merge(p) for p in self.split(text))

    def _word(self, word: str) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= MEMO_LIMIT:
                self.words.clear()
            known = self.words[word] = self._pre_tokens(word)
        return known

    def _plain(self, text: str) -> int:
        """A text without special strings. Between single blanks each word, with the blank
        before it, splits as it would alone; other texts are split as a whole."""
        if not text:
            return 0
        if UNSAFE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if BLANK_RUN.search(text):
            return self._pre_tokens(text)
        first, *rest = text.split(" ")
        known, word = self.words.get, self._word
        return word(first) + sum(known(w) or word(w) for w in map(" ".__add__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special_cut is None or self.special_cut.search(text) is None:
            return self._plain(text)
        parts = self.special_cut.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", limit: int = 512
) -> DataFrame:
    """Rows ``(key, n_bytes, n_tokens, over_limit)``, one for each row of ``docs``.

    A null text counts as empty: 0 bytes, 0 tokens, not over the limit. Repeated rows and
    null keys are counted row by row; an empty table gives none. Only the two named
    columns are read, so other columns may have any name. Special strings inside a text
    count one token each, as the library has it by default.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer).count
        for batch in batches:
            n = pa.array([count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["key", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.col(key).alias("key"), n_bytes.alias("n_bytes"), F.col(text).alias("text"))
    counts = rows.mapInArrow(counted, f"key {key_type}, n_bytes long, n_tokens long")
    return counts.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
