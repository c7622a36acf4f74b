import zlib

import numpy as np
import pytest

from tickerlake.llm import token_files
from tickerlake.llm.common import scratch
from tickerlake.llm.queries import op9_token_files, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, docs_of

NASTY = ["", None, "  \t\n ", "Don't STOP'S 's", "<|endoftext|> a<|STARTOFTEXT|>b <|startoftext|>", "Élan É e\u0301 ÀÇ İstanbul ﬁ ß",
         "a\u00a0b\u2003c\u3000d\x1cx\x85y", "12 345 x9y a.b,c! (hi) ...", "漢字 かな 🙂👍🏽", "ſ K Å क़ क़.", "a\x00b", "word, word. word; WORD", LONG]


def reference(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, at = [], 0
    for (i, _), ids in zip(rows, reference([t for _, t in rows])):
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_encoder_equals_library():
    enc = token_files.WordEncoder(tokenizer_path(), False)
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode(NASTY)] == [x[:-1] for x in reference(NASTY)]


def test_encoder_equals_library_on_random_unicode():
    """Capitals, marks, Hangul, Indic and other letters, punctuation, in all mixtures."""
    rng = np.random.default_rng(12)
    pools = [range(0x41, 0x5B), range(0x61, 0x7B), range(0xC0, 0x250), range(0x300, 0x345), range(0x900, 0x980), range(0xAC00, 0xAC80),
             range(0x1100, 0x1200), range(0x370, 0x530), range(0x1E00, 0x1F00), range(0x21, 0x41), range(0x2000, 0x2070), range(0x1F600, 0x1F640), [32]]
    texts = []
    for _ in range(20_000):
        some = rng.choice(len(pools), 3)
        texts.append("".join(chr(int(rng.choice(pools[some[k]]))) for k in rng.integers(0, 3, rng.integers(1, 9))))
    texts += ["J\u030c H\u0331 T\u0308 W\u030a Y\u030a", "\u0130;", "A\u030a.", "I\u0307,x"]
    enc = token_files.WordEncoder(tokenizer_path(), False)
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode(texts)] == [x[:-1] for x in reference(texts)]


def test_encoder_when_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    enc = token_files.WordEncoder(tokenizer_path(), False)
    for _ in range(2):
        for t in NASTY:
            assert np.frombuffer(enc.encode([t])[0], "<u2").tolist() == reference([t])[0][:-1]


def test_words_with_tails_go_to_the_library_as_letters_and_tails():
    """Of words that differ in capitals and punctuation only the letters and the tails are encoded, once each; the letters
    in one text. (They were given to the library one by one where the tail was not one of .,!?;:.)"""
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    texts = [f"{w}{a}{b} {w}{a}" for w in ("Élan", "word", "WORD", "ñandú", "straße") for a in ("", *marks) for b in marks]
    texts += ["don't's'", "x''s", "a'S", "x's.", "it's***", "7%%%", "a1***", "***", "a.b***", "e\u0301***", "Ж***", "x<|endoftext|>***", "<|***"]
    enc = token_files.WordEncoder(tokenizer_path(), False)
    given = []

    class Counted:
        def encode_batch_fast(self, words, **how):
            given.extend(words)
            return tok.encode_batch_fast(words, **how)

    tok, enc.tok = enc.tok, Counted()
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode(texts)] == [x[:-1] for x in reference(texts)]
    assert len(given) == len(set(given))
    assert not [w for w in given if w[:4].lower() in ("élan", "word", "ñand", "stra")]


def test_tokenizer_of_another_kind(tmp_path):
    """One that keeps capitals and cuts at white space only is left to the library."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    tok = Tokenizer(models.WordLevel({"Word.": 0, "word": 1, "b": 2, "?": 3}, unk_token="?"))
    tok.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tok.save(path := str(tmp_path / "other.json"))
    enc = token_files.WordEncoder(path, False)
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode(["Word. word  b", None, "word. B"])] == [[0, 1, 2], [], [3, 3]]


@pytest.mark.parametrize("files", [1, 5])
def test_files_round_trip(spark, files):
    rows = [(7 * i % 13 - 3, t) for i, t in enumerate(NASTY)] + [(None, "x y"), (2, "same"), (2, "same")]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    folder = scratch(spark, "test-tokens")
    listed = token_files.write_token_files(docs, folder, tokenizer_path(), 2, files=files).orderBy("file").collect()
    got = sorted(token_files.read_token_digests(spark, folder).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == expected(rows)
    assert [r.base for r in listed] == list(np.cumsum([0] + [r.tokens for r in listed])[:-1])
    files = token_files.TokenFiles(folder)
    assert len(files) == len(rows)
    for i, r in enumerate(got):
        assert len(files[i]) == r.n_tokens and files[i][-1] == 2
    # A task that runs again replaces its files with the same bytes.
    token_files.write_token_files(docs, folder, tokenizer_path(), 2, files=len(listed))
    assert sorted(token_files.read_token_digests(spark, folder).collect(), key=lambda r: r.start) == got


def test_empty(spark):
    assert token_files.token_digests(docs_of(spark, []), tokenizer_path()).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op9_token_files(spark, SF_SMALL).collect()), key=lambda r: r[1])
    assert got == expected(rows)
