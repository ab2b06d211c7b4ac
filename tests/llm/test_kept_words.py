"""A worker's tokens of words: what comes again outlasts what came once."""

from brightvault.llm import tokens


def test_words_that_come_again_are_merged_once(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 8)
    bpe, merged = tokens.Bpe(tokens.load()), []
    short = bpe.short
    bpe.short = lambda parts: merged.append(tuple(parts)) or short(parts)
    texts = [f"again{' once' * (i > 0)}x{'abcdefghijklmnopqrstuvwxyz'[i]}" for i in range(26)]
    got = [bpe.encode(f"again {t}") for t in texts]
    again = tuple(bpe.start[b] for b in b"again")
    assert merged.count(again) == 1
    assert len(bpe.known) <= 8 and len(bpe.older) <= 8
    monkeypatch.setattr(tokens, "KEPT", 1000)
    fresh = tokens.Bpe(tokens.load())
    assert got == [fresh.encode(f"again {t}") for t in texts]
