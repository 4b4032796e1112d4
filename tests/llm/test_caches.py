"""What a worker caches is bounded, and changes no result."""

from strandwise.llm import packing


def test_full_caches_keep_the_oldest_and_change_no_ids(monkeypatch):
    tokenizer = packing.RunTokenizer(packing.MODEL)
    tokenizer.runs.clear(), tokenizer.words.clear()
    monkeypatch.setattr(packing, "CACHED", 40)
    monkeypatch.setattr(packing, "KEPT", 10)
    texts = [f"the cat-{k} sat, on {k * 7919} mats; été <|x|> {k:x}" for k in range(60)]
    got = list(tokenizer.ids(texts))
    assert got == tokenizer._encode(texts) and "the" in tokenizer.runs and len(tokenizer.runs) < 60
