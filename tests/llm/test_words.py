"""Vectorised word hashes: equal exactly when the words are."""

from hypothesis import given, settings
from hypothesis import strategies as st

from lineage_spark.llm import common
from lineage_spark.llm.common import word_hashes, words_of


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbBéÉ \t\n\x0b\x0c\r\x85\u00a0x1\U0001F600", max_size=40), max_size=6))
def test_hashes_follow_words(texts):
    seen = {}
    for t in texts:
        words, hashes = words_of(t), word_hashes(t).tolist()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes):
            assert seen.setdefault(h, w) == w
    assert len(set(seen.values())) == len(seen)


def test_long_texts_go_in_pieces(monkeypatch):
    text = " ".join(f"w{i}" for i in range(5000)) + " " + "long" * 500
    whole = word_hashes(text).tolist()
    monkeypatch.setattr(common, "_PIECE", 97)
    assert word_hashes(text).tolist() == whole
    assert len(set(whole)) == 5001


def test_no_text():
    assert word_hashes(None).tolist() == word_hashes("").tolist() == word_hashes(" \n").tolist() == []
