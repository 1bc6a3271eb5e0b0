"""Token counts by a whole-token shortcut.

The model merges characters into pieces, and no piece holds a word mark after
another character, nor a line feed. So a text falls into pre-tokens that
encode independently: a run of word marks with the characters behind it, or a
stretch between line feeds. ``whole_token_words`` checks this for the given
model and lists the words that encode alone as exactly one token. Matching
pre-tokens count one each without calling the tokenizer; only the others are
merged by the library (each distinct one once, kept in a bounded table).
"""

from __future__ import annotations

import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tradewell.llm.common import register, small_batches, table

MARK = "▁"  # the model's word mark, which stands for a space


def whole_token_words(proto: bytes) -> list[str]:
    """Vocabulary strings that encode alone as one token, without their mark.

    Raises ValueError if the model does not let pre-tokens be counted apart."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
        raise ValueError("pieces cross a pre-token border: the shortcut does not hold")
    if sp.encode("  a ", out_type=str) == sp.encode("a", out_type=str) or sp.encode("\n", out_type=str)[0] != MARK:
        raise ValueError("the model changes white space: the shortcut does not hold")
    words = [(p[1:], i) for i, p in enumerate(pieces) if p[0] == MARK and len(p) > 1 and p[1] != MARK]
    return [w for (w, i), ids in zip(words, sp.encode([w for w, _ in words])) if ids == [i]]


class PreTokens(dict):
    """Tokens of a pre-token; a missing one is merged by the library. At most
    ``most`` merged pre-tokens of moderate length are kept."""

    def __init__(self, sp, known, lead: str, less: int, most: int):
        super().__init__(known)
        self.sp, self.known, self.lead, self.less, self.most = sp, known, lead, less, most

    def __missing__(self, key: str) -> int:
        n = len(self.sp.encode(self.lead + key)) - self.less
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
                self.update(self.known)
            self[key] = n
        return n


def make_counter(proto: bytes, words: list[str], most: int = 200_000):
    """A function text -> number of tokens."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    marked = PreTokens(sp, dict.fromkeys(words, 1) | {"": 1}, "", 0, most)  # "": a mark alone
    bare = PreTokens(sp, {"": 0}, "\n", 2, most)  # behind a line feed: no mark in front
    pre = re.compile(" *[^ ]+| +$").findall

    def behind_marks(s: str) -> int:  # s starts with a space
        if "  " in s or s[-1] == " ":
            return sum(marked[x[1:]] for x in pre(s))
        return sum(map(marked.__getitem__, s[1:].split(" ")))

    def count(text: str) -> int:
        if not text:
            return 0
        first, *lines = text.replace(MARK, " ").split("\n")
        # an empty first line still has the mark that starts every text
        n = behind_marks(" " + first) if first else 1
        for line in lines:
            head, gap, rest = line.partition(" ")
            n += 1 + bare[head] + (behind_marks(gap + rest) if gap else 0)
        return n

    return count


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; null ids stay; repeated rows
    stay repeated; an empty table gives an empty result; other columns are not
    read. The driver reads the model file once and sends its bytes (below 1 MB)
    to the executors, which need no file."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_path, "rb") as f:
        proto = f.read()
    sent = spark.sparkContext.broadcast((proto, whole_token_words(proto)))

    def run(batches):
        count = make_counter(*sent.value)
        for b in batches:
            texts = b.column(1).fill_null("")
            if not pa.types.is_large_string(texts.type):
                texts = texts.cast(pa.string())
            sizes, tokens = [], []
            for t in texts:
                s = t.as_py()
                sizes.append(len(s) if s.isascii() else len(s.encode()))
                tokens.append(count(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(id_col, text_col)
    out = StructType([src.schema[0], StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
                      StructField("over_limit", BooleanType())])
    return src.mapInArrow(run, out)


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
