"""op1_token_records: words reach the tokenizer in bulk, with the library's own results."""

import json
import random
import sys

import public_tokenizers as P
import pyarrow as pa
import pytest

from tradelake.llm import token_records

tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("byte_bpe_50k.json")


def library(path: str, texts: list[str]) -> list[list[int]]:
    t = tokenizers.Tokenizer.from_file(path)
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_python_work_does_not_grow_with_distinct_words():
    """CPU seconds a GB were over the limit: each distinct word cost several calls from Python."""
    r = random.Random(1)
    words = ["".join(r.choice("abcdeéñst") for _ in range(8)) + r.choice(["", ",", "&&&", ".\nUn"]) for _ in range(20_000)]
    texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
    encoder, calls = token_records.tokenizer_encoder(PATH, 0, False), 0
    list(encoder.encoded(pa.array(["imports of libraries", "don't count"])))

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = list(encoder.encoded(pa.array(texts)))
    finally:
        sys.setprofile(None)
    assert [x.tolist() for x in got] == library(PATH, texts)
    assert calls < 2_000, calls  # 20 texts


def test_odd_words_beside_simple_ones():
    r = random.Random(2)
    kinds = [*"abzABZ019,.&$!<>|\"\\_'’éß×÷ªµÀɏɐ字²\x00\x7f😀", "\n", "<|endoftext|>", "'s", "'ll", "the", "tion"]
    texts = [" ".join("".join(r.choice(kinds) for _ in range(r.randint(1, 8))).strip("\n") or "x" for _ in range(60)) for _ in range(400)]
    encoder = token_records.tokenizer_encoder(PATH, 0, False)
    assert [x.tolist() for x in encoder.encoded(pa.array(texts))] == library(PATH, texts)


@pytest.mark.parametrize("pair", [("a", ","), (",", "Ġ"), ("a", "Ġ"), ("1", "a"), ("Ċ", "a"), ("Ġ", "a"), ("Ġ", ",")])
def test_a_vocabulary_that_joins_what_the_pattern_parts(tmp_path, pair):
    """A merge across two pre-tokens never happens in the library, whatever the vocabulary holds."""
    whole = json.loads(open(PATH, encoding="utf-8").read())
    letters = list(token_records.byte_characters().values())
    whole["model"]["vocab"] = {c: i for i, c in enumerate([*letters, "".join(pair)])}
    whole["model"]["merges"], whole["added_tokens"] = [list(pair)], [{**x, "id": 300} for x in whole["added_tokens"]]
    path = str(tmp_path / "own.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(whole, f)
    texts = ["b a, a a1a 1a\na ,, a, b", "a,a ,a a\n,a 1,a a"]
    encoder = token_records.tokenizer_encoder(path, 0, False)
    assert [x.tolist() for x in encoder.encoded(pa.array(texts))] == library(path, texts)


def test_tokens_of_two_pre_tokens_are_told():
    across = ["a,", ",a", "a ", ", ", "1a", "a\n", "\na", " a,", "é.", "a b"]
    within = ["a", " a", ",.", " ,.", " 12", " ", "\n", "  ", "\n\n", "\u00a0 \u00a0", "a'", "<|", "字,", "é"]
    assert [t for t in across if not token_records.crosses(t.encode(), ",.")] == []
    assert [t for t in within if token_records.crosses(t.encode(), ",.")] == []
    assert not token_records.crosses(b"\xa9\xc3", ",.") and token_records.crosses(b"\xa9,", ",.") and token_records.crosses(b",\xc3", ",.")
