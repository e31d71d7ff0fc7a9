"""Token counts by a two-tier lookup, on the map side.

A text's token count is the sum over its pre-tokens, the pieces that the tokenizer's own rule cuts before it
merges. The first tier is a compact table with the lengths of the frequent pre-tokens: the whole words of the
tokenizer's vocabulary, counted by the library itself. It has no more entries than the vocabulary and is
broadcast. Misses are encoded by the library once and kept in the worker's cache, the second tier. So each document
is one narrow row of work and no pre-token is ever shuffled.

The cutting rule is repeated here for texts of characters for which it is the same beyond doubt (Latin letters
and ASCII, without control characters); any other text is normalized and cut by the library's own stages, and its
pre-tokens are looked up all the same. Strings of special tokens are one token each and part the text. Hence the counts
are the library's for every text.

Defined cases. Null text: 0 bytes, 0 tokens. Texts are taken whole, repeated rows are counted each. Other columns are
ignored. A cache that reaches its bound starts again from the table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
CACHE_ENTRIES = 1_000_000

#: Texts of these characters only: tab, line ends, printable ASCII and Latin letters and signs, without
#: superscript digits, fractions and the dotted capital I, whose classes or lower case differ between libraries.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ]*")
#: Fixed value: the pre-token rule of the vocabulary, for such texts.
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

#: Marks a key that is in byte letters already; no pre-token begins with it.
_MAPPED = "\0"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def frequent_lengths(path: str) -> dict[str, int]:
    """Lengths of the whole ASCII words of the vocabulary."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = [w for k in vocabulary if (w := k.removesuffix("</w>")) != k and w.isascii() and _PRETOKEN.fullmatch(w)]
    return dict(zip(words, _lengths(_library(path), words), strict=True))


def worker_counter(path: str, table: dict[str, int]) -> Counter:
    """The counter of this worker process, kept from task to task with its cache."""
    kept = sys.modules.setdefault("_kept_token_counters", types.ModuleType("_kept_token_counters")).__dict__
    if path not in kept:
        kept[path] = Counter(path, table)
    return kept[path]


class Counter:
    """Token counts of texts in one worker."""

    def __init__(self, path: str, table: dict[str, int], entries: int = CACHE_ENTRIES):
        from tokenizers import pre_tokenizers

        self.tokenizer, self.table, self.entries = _library(path), table, entries
        self.cache = dict(table)
        self.model = self.tokenizer.model
        self.bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def count(self, text: str) -> int:
        """Tokens of a text; a special token's string is one and parts the text, as the vocabulary marks these as not normalized."""
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.looked_up, parts))

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens as keys of the cache: ASCII or plain ones as they are, others as the library's byte letters."""
        if _PLAIN.fullmatch(text):
            return _PRETOKEN.findall(text.lower())
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [w if w.isascii() else _MAPPED + w for w, _ in cut]

    def looked_up(self, text: str) -> int:
        pretokens = self.pretokens(text)
        try:
            return sum(map(self.cache.__getitem__, pretokens))
        except KeyError:
            if len(self.cache) > self.entries + len(self.table):
                self.cache = dict(self.table)
            for word in set(pretokens).difference(self.cache):
                self.cache[word] = self.merged(word)
            return sum(map(self.cache.__getitem__, pretokens))

    def merged(self, word: str) -> int:
        """Length of one pre-token, by the library's byte mapping and merges."""
        if word[0] == _MAPPED:
            return len(self.model.tokenize(word[1:]))
        letters = word if word.isascii() else self.bytewise.pre_tokenize_str(word)[0][0]
        return len(self.model.tokenize(letters))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(vocabulary_path(vocabulary)))

    def run(batches):
        counter = worker_counter(vocabulary_path(vocabulary), table.value)
        for batch in batches:
            counts = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", n_bytes)
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
