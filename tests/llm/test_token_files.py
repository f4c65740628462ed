"""Token files: exact round trip, order and format."""

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lineage_spark.llm import token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return token_files._tokenizer(WORDS).encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300) | st.integers(0, 70000), max_size=300))
@settings(max_examples=200, deadline=None)
def test_ranks_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == (len(values) + 3) // 4
    assert len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    got = token_files.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert got.tolist() == values


ODD = ["a", "B", "word", "(word", "Straße,", "it's", "'tis", "dogs'", "x.y", "a1", "((", "É!", "x<|y|>z", "<|startoftext|>", "ÿ", "×", "÷", "Ð", "'s", "'", "1", "é", "é", "́", "ͅ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ",
       "　", "Σ", "İ", "漢", "ㄱ", "가", "😀", "<|endoftext|>", "<|", "|>", "!", "...", "\x00", "ſ", "ﬁ"]


def encoded(encoder, texts):
    ids, sizes = encoder(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


@given(st.lists(st.sampled_from(ODD) | st.text(max_size=4), max_size=40))
@settings(max_examples=400, deadline=None)
def test_pieces_encode_as_the_whole_text(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode("utf-8")
    got = encoded(token_files.Encoder(WORDS), [text, "", text[::-1]])
    assert got == [whole(text), [], whole(text[::-1])]


def test_long_texts_and_a_full_memory(monkeypatch):
    monkeypatch.setattr(token_files, "RUN_CHARS", 50)
    monkeypatch.setattr(token_files, "CACHED_PIECES", 20)
    r = random.Random(2)
    encoder = token_files.Encoder(WORDS)
    for _ in range(20):
        text = " ".join("".join(r.choices("abcXYZ019é,.'", k=r.choice([1, 3, 8, 70]))) for _ in range(100))
        assert encoded(encoder, [text, text[:30], text]) == [whole(text), whole(text[:30]), whole(text)]
    assert max(len(encoder.pieces.newer), len(encoder.words.newer)) <= 20 + 101  # a full memory and what one run adds
    assert max(map(len, [*encoder.pieces.newer, *encoder.words.newer])) <= token_files.CACHED_CHARS


def brute(rows, end):
    out, at = [], 0
    coded = [(k, np.array(whole(t) + [end], "<u4").tobytes()) for k, t in rows]
    for k, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1]), len(x[1]))):
        out.append((k, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def sample():
    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["the", "Quick", "brown", "fox", "été", "12", "漢字", "\n", "a-b"], k=r.choice([0, 1, 9, 300])))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 90000), (1003, "x" * 200000), (-5, "first"), (None, "null key"), (None, None)]
    rows += [(7, "another text of key 7"), (7, None)] + rows[:30] + [(42, "copy")] * 200
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("per_file,block", [(1 << 23, 1 << 16), (1000, 64)])
def test_files_match_brute_force(spark, monkeypatch, per_file, block):
    rows = sample()
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, start int, __ids string").repartition(5)
    if block != token_files.BLOCK:  # a worker has the module's own block; write and read one file here instead
        monkeypatch.setattr(token_files, "BLOCK", block)
        out, ids = token_files._FileWriter(), [np.array(whole(t) + [1], np.uint32) for _, t in rows]
        for (k, _), i in zip(rows, ids):
            out.add(None if k is None else str(k), i)
        uri = f"file://{token_files.scratch_path(spark, 'one').removeprefix('file:')}/x.tok"
        token_files._put(uri, out.parts())
        back = token_files.TokenFile(uri, np.arange(60000, dtype="<u4"))
        got = [(k, at, np.concatenate(p).tolist()) for k, at, p in back.documents()]
        starts = np.cumsum([0] + [len(i) for i in ids]).tolist()
        assert got == [(None if k is None else str(k), s, i.tolist()) for (k, _), s, i in zip(rows, starts, ids)]
        flat = np.concatenate(ids)
        for a, b in ((0, 5), (60, 70), (64, 128), (100, 5000), (len(flat) - 3, len(flat)), (9, 9)):
            assert [v for piece in back.ids(a, b) for v in piece.tolist()] == flat[a:b].tolist()
        return
    files = token_files.write(df, WORDS, ids_per_file=per_file)
    got = [tuple(r) for r in files.documents().collect()]
    assert files.documents().columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(got, key=lambda x: x[1]) == brute(rows, 1)


@pytest.mark.parametrize("end", [9, 70000])
def test_small_files_ids_and_ranks(spark, end):
    rows = sample()[:200]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = token_files.write(df, WORDS, end_id=end, ids_per_file=200)
    assert files.files.count() > 10
    got = files.documents(with_ids=True).collect()
    assert sorted([tuple(r)[:4] for r in got], key=lambda x: x[1]) == brute(rows, end)
    texts = {}
    for k, t in rows:
        texts.setdefault(k, []).append(whole(t) + [end])
    assert all(list(r["ids"]) in texts[r["doc_id"]] for r in got)
    counts = collections.Counter(i for _, t in rows for i in whole(t) + [end])
    assert files.ids_by_rank().tolist() == sorted(counts, key=lambda i: (-counts[i], i))


def test_text_keys_and_empty_tables(spark):
    df = spark.createDataFrame([("b", "two"), ("a", "one"), ("", "")], "name string, body string")
    out = token_files.write(df, WORDS, key="name", text="body").documents().orderBy("start").collect()
    assert [(r["name"], r["start"], r["n_tokens"]) for r in out] == [("", 0, 1), ("a", 1, 2), ("b", 3, 2)]
    none = token_files.write(df.where("false"), WORDS, key="name", text="body")
    assert none.documents().collect() == [] and none.documents().columns == ["name", "start", "n_tokens", "ids_crc32"]
