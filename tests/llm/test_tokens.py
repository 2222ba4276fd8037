import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from poststream.llm.tokens import TokenEncoder, splitting_kind, tokenizer_path, with_end

ODD = ["", " ", "a", "  a  b ", "it's 's 're\n\n x", "a  \n b c  d", "x<|endoftext|>\n\ny",
       "  <|endoftext|> foo <|startoftext|>", "<|STARTOFTEXT|>", "É é Σ ΑΣ ΑΣ.", "é ́x",
       "日本語 テスト　全角", "1234 5,6", "\x1c\x1d a", "a\x85b \x85 c", None, "a\xa0\xa0 b\xa0\n c",
       "\t\ta\x0b\x0cb\r\nc", "İstanbul ǅ", "word,word.Word!?", "a≮b", "q" * 300]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_plain_encode(name):
    rng = random.Random(5)
    signs = "abEZ 1',.(-\n\t é.<|>sAΣ\x1ć ÀÞ"
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    plain, enc = Tokenizer.from_file(tokenizer_path(name)), TokenEncoder(
        tokenizer_path(name), splitting_kind(tokenizer_path(name)), 100)
    for _ in range(2):  # the second time from the cache
        for part in (texts, texts[:3]):
            ids, counts = enc.encode(pa.array(part, pa.string()))
            at = 0
            for text, n in zip(part, counts.tolist()):
                assert ids[at: at + n].tolist() == plain.encode(text or "", add_special_tokens=False).ids
                at += n
            assert at == len(ids)


def test_end_ids():
    import numpy as np
    ids, counts = with_end(np.array([5, 6, 7], np.uint32), np.array([2, 0, 1]), 1)
    assert ids.tolist() == [5, 6, 1, 1, 7, 1] and counts.tolist() == [3, 1, 2]


def test_new_words_cost_few_python_calls():
    import cProfile
    import pstats
    rng = random.Random(2)
    words = list({"".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=9)) for _ in range(6000)})
    path = tokenizer_path("word_bpe_49k.json")
    enc, column = TokenEncoder(path, splitting_kind(path)), pa.array([" ".join(words)], pa.string())
    watch = cProfile.Profile()
    ids, _ = watch.runcall(enc.encode, column)
    assert pstats.Stats(watch).total_calls < 5 * len(words)
    assert ids.tolist() == Tokenizer.from_file(path).encode(
        column[0].as_py(), add_special_tokens=False).ids


def test_letters_that_the_vocabulary_lacks(tmp_path):
    import json
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as fh:
        spec = json.load(fh)
    spec["model"] |= {"vocab": {"a": 0, "b": 1, "a</w>": 2, "b</w>": 3, "ab</w>": 4},
                      "merges": [["a", "b</w>"]]}
    spec["added_tokens"] = []
    path = tmp_path / "few.json"
    path.write_text(json.dumps(spec))
    texts = ["ab ac ca cc bab", "", "  ", "ba ab", "c"]
    enc, plain = TokenEncoder(str(path), splitting_kind(str(path))), Tokenizer.from_file(str(path))
    for column in (texts, texts[2:3], texts[4:], texts[3:4]):
        ids, counts = enc.encode(pa.array(column, pa.string()))
        want = [plain.encode(t, add_special_tokens=False).ids for t in column]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
