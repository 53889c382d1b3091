"""Token counts without merging most words: pre-tokens proven to be one token count as one."""

from __future__ import annotations

import os

import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tripstream.llm.common_arrow import appended, texts_of
from tripstream.llm.pretokens import PieceCache, held

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048


class TokenCounter:
    """Counts the tokens of texts; the proof runs once, over the vocabulary alone."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else lambda text: text
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = tokenizer.model.tokenize
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
        added = tokenizer.get_added_tokens_decoder().values()
        strings = (t[: len(t) - len(suffix)] for t in tokenizer.get_vocab(with_added_tokens=False) if t.endswith(suffix))
        #: Strings that, alone, merge into one token whatever stands around them: a pre-token is merged by itself.
        self.whole = frozenset(s for s in strings if s and len(self.merge(s)) == 1)
        self.specials = regex.compile("|".join(regex.escape(t.content) for t in added)) if added else None

    def plain(self, text: str) -> int:
        whole, merge = self.whole, self.merge
        return sum(1 if w in whole else len(merge(w)) for w, _ in self.split(self.normalize(text)))

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece; a special string is one token, as the library takes it."""
        found = []
        for piece in pieces:
            if self.specials is not None and "<" in piece and (n := len(self.specials.findall(piece))):
                found.append(n + sum(map(self.plain, self.specials.split(piece))))
            else:
                found.append(self.plain(piece))
        return found


def count_cache(vocabulary: str) -> PieceCache:
    return held(("counts", vocabulary), lambda: PieceCache(TokenCounter(vocabulary).counts))


def token_counts(docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """docs without their text, with n_bytes (UTF-8), n_tokens and over_limit (more tokens than the limit).

    Null and empty texts count nothing; texts of any length are counted whole; rows are independent, so ties,
    repeated rows and empty tables need no rule. Columns that bear an added name are replaced; others pass through.
    """

    def make():
        cache = count_cache(vocabulary)

        def work(batch):
            texts = texts_of(batch, text_column)
            counts = [sum(v) for v in cache.of(texts)]
            return [[len(t.encode()) for t in texts], counts, [n > limit for n in counts]]

        return work

    added = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    return appended(docs, added, make, keep=[c for c in docs.columns if c != text_column])


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
