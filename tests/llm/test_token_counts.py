import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from tradewell.llm.common import table
from tradewell.llm.queries import QUERIES
from tradewell.llm.token_counts import count_tokens, make_counter, whole_token_words

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
with open(PATH, "rb") as f:
    PROTO = f.read()
SP = sentencepiece.SentencePieceProcessor(model_proto=PROTO)
COUNT = make_counter(PROTO, whole_token_words(PROTO), most=40_000)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab the\n \t▁é<s>/中 🙂\r.1"), max_size=40) | st.text(max_size=30))
def test_counts_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert COUNT(text) == len(SP.encode(text))


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op8_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        n = len(SP.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 4096)


def test_odd_rows(spark):
    rows = [(1, None, 9), (None, "", 9), (3, "x " * 50_000, 9), (3, "x " * 50_000, 9), (4, "  a\n\n b ", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in count_tokens(df, PATH).collect())
    want = sorted((i or 0, len(SP.encode(t or ""))) for i, t, _ in rows)
    assert got == want
    assert count_tokens(df.limit(0), PATH).count() == 0
