import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer, normalizers

from strandline.llm import rankbpe
from strandline.llm.common import table
from strandline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def path(spark):
    return rankbpe.vocabulary_path(spark)


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def mine(path):
    return rankbpe.RankBpe(path)


def same(mine, library, texts):
    got = mine.encode(texts)
    for t, e, g in zip(texts, library.encode_batch(texts, add_special_tokens=False), got, strict=True):
        assert np.frombuffer(g, "<u4").tolist() == e.ids, t[:60]
        assert mine.decode(g).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_awkward_texts(mine, library):
    same(mine, library, ["", " ", "Hello world's <|endoftext|> Don't it'll!! 'sand ,'s 12 é ΑΣ", "a<|startoftext|><|endoftext|>b<|endoftext", "İstanbul ıI ǅ ﬁ ẞ", "é ''s 's' 'S 'RE're 're", "'", "' s", "'l", "'lla", "1'2's", "日本語テキスト。中文", "a b c\x85d\x1ce", "👩‍👩‍👧 😀'm", "x'" + "s" * 9, "한"])
    rng = random.Random(1)
    same(mine, library, ["".join(rng.choice("ab'srevlmdt 1.,é́日<|>\nΣ") for _ in range(rng.randint(0, 40))) for _ in range(3000)])


def test_every_code_point(mine, library):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(chars[i : i + 64]) for i in range(0, len(chars), 64)]
    same(mine, library, texts)


def test_composed_ranges_need_no_normaliser():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not rankbpe.COMPOSED.search(chr(c))]
    text = "".join(chars) + "".join(reversed(chars))
    assert normalizers.NFC().normalize_str(text) == text


def test_long_words_by_both_ways(mine, library):
    rng = random.Random(4)
    words = ["".join(rng.choice(a) for _ in range(n)) for a in ("a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyzé") for n in (1, 2, 63, 64, 65, 66, 400)]
    same(mine, library, [*words, "a" * 30_000, "".join(rng.choice("thean") for _ in range(30_000))])
    raw = [w.encode() for w in words]
    by_scan = mine.merge(raw)
    for w, x in zip(raw, by_scan, strict=True):
        ids = mine.inner[np.frombuffer(w, np.uint8)]
        ids[-1] = mine.final[w[-1]]
        assert mine.merge_long(ids).astype("<u4").tobytes() == x


def test_pieces_of_a_long_text(mine, library):
    rng = random.Random(3)
    for alphabet in ("ab' 1,é\n", "ab1+/'|<>é", "日本"):
        text = "".join(rng.choice(alphabet) for _ in range(600)) + "<|endoftext|> é 'll"
        data = text.encode()
        for limit in (5, 40, 10_000):
            cut = list(rankbpe.pieces(data, limit))
            assert b"".join(cut) == data
            got = b"".join(x for p in cut for x in mine.encode([p.decode()]))
            assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back


def test_rows(spark, library):
    long = "The quick brown fox's 12 jumps, é! " * 150_000
    rows = [(1, "Hello World"), (2, None), (3, ""), (4, " \t"), (None, "no id"), (1, "Hello World"), (6, long), (7, "x" * 200_000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int")
    out = rankbpe.encode_words(df)
    got = sorted(out.collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    for r, (i, t) in zip(got, sorted(rows, key=lambda r: (r[0] or 0, len(r[1] or ""))), strict=True):
        ids, one, back, _ = digests(library, t)
        assert (r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) == (i, len(ids), one, back)
        assert r.ids == (None if t is None else ids)
    texts = {r.doc_id: r.text for r in rankbpe.decode_words(out.where("doc_id < 5")).collect()}
    assert texts == {1: "hello</w> world</w>", 2: None, 3: "", 4: ""}
    assert rankbpe.encode_words(df.limit(0)).count() == 0


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_word_bpe"](spark, sf).collect()}
    want = {}
    for r in table(spark, sf, "documents").collect():
        ids, one, back, _ = digests(library, r.text)
        want[r.doc_id] = (len(ids), one, back)
    assert got == want
