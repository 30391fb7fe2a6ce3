"""Ids against ``tokenizers`` as its file gives it, added tokens included."""
import numpy as np
import pytest

from barpanel.llm.packing import LONG_SPACE, encoder, pack
from tests.llm.helpers import docs

SPECIAL = ["see <|endoftext|> here", "<|endoftext|>", "  <|endoftext|>  x",
           "a<|endoftext|><|endoftext|>b", "x \n <|endoftext|>\n\n<|endoftext|", "<|<|endoftext|>|>",
           "<|endoftext|>'s", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens(spark, tokenizer):
    assert encoder()("see <|endoftext|> here").tolist() == [3826, 220, 50256, 994]
    got = {}
    for r in pack(docs(spark, SPECIAL), 4).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(SPECIAL):
        parts = sorted(got[i], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist()
        assert ids == tokenizer.encode(t, add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", [
    "a" + " " * 1_100_000 + "b", "\n" * 1_100_000, "<|endoftext|>" + "　 " * 550_000 + "x",
    " " * (LONG_SPACE - 1) + "x", "x" + "\t" * LONG_SPACE])
def test_long_white_space(tokenizer, text):
    assert encoder()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
